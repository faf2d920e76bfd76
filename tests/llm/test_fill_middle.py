"""Fill-in-middle against slices of Python strings, SQL, and exact round trips."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from provgraph.llm import fill_middle as fim

RUN = fim.RUN
TEXTS = [None, "", "a", "é漢😀", "x" * RUN, "y" * (RUN + 1), "😀a" * 700, "line\nline\r\n\ttab " * 90, "holds <S> inside", "almost <S <P << >", "<" * 300 + ">", "word " * 60_000, "same", "same"]


def _plain(doc_id, text, plan=fim.Plan()):
    """(form, low, high, output) by plain slices."""
    t = text or ""
    digest = hashlib.sha256(f"{plan.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    if not t or any(m in t for m in plan.marks) or h[2] % 100 >= plan.arranged:
        return "plain", None, None, t
    p, m, s = plan.prefix + t[:low], plan.middle + t[low:high], plan.suffix + t[high:]
    return ("spm", low, high, s + p + m) if h[3] % 100 < plan.spm else ("psm", low, high, p + s + m)


def _docs(spark):
    rows = [(100 * k + i, t, "clash", "clash") for k in range(12) for i, t in enumerate(TEXTS)] + [(None, "no id at all", "x", "x"), (7, "twice", "x", "x"), (7, "twice", "x", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, form string, runs string"), rows


def test_arrangements_agree_with_plain_slices(spark):
    docs, rows = _docs(spark)
    want = {(i, t or ""): _plain(i, t) for i, t, *_ in rows}
    got = fim.arranged(docs).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        form, low, high, output = want[r["doc_id"], r["text"]]
        assert (r["form"], r["prefix_chars"], r["middle_chars"]) == (form, low, None if low is None else high - low)
        assert r["output"] == output and r["back"] == r["text"] and r["n"] == len(r["text"])


def test_every_cut_of_long_texts(spark):
    """Cuts at and about the borders of runs: many ids over texts of two runs and a bit."""
    text = "".join(chr(0x4E00 + i) if i % 3 else "😀" for i in range(2 * RUN + 3))
    docs = spark.range(1500).select(F.col("id").alias("doc_id"), F.substring(F.lit(text), 1, (F.col("id") % (2 * RUN + 4)).cast("int")).alias("text"))
    got = fim.arranged(docs).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    for r in got:
        assert r["output"] == _plain(r["doc_id"], text[: r["doc_id"] % (2 * RUN + 4)])[3] and r["back"] == r["text"]


def test_hashes_agree_with_sql(spark):
    docs, rows = _docs(spark)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    found = fim.fill_in_middle(docs)
    want = con.sql(f"SELECT {', '.join(found.columns)} FROM ({fim.ORACLE_SQL})").fetchall()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


def test_own_plans(spark):
    docs, rows = _docs(spark)
    plan = fim.Plan(arranged=100, spm=50, seed=5, prefix="[pre]", suffix="[suf]", middle="[mid]")
    got = fim.arranged(docs, plan).withColumn("back", fim.restored(F.col("output"), F.col("form"), plan)).collect()
    assert all(r["output"] == _plain(r["doc_id"], r["text"], plan)[3] and r["back"] == r["text"] for r in got)
    for marks in (("<P>", "<P>x", "<M>"), ("ab", "bc", "d"), ("aba", "x", "y"), ("", "x", "y")):
        with pytest.raises(ValueError):
            fim.Plan(prefix=marks[0], suffix=marks[1], middle=marks[2])


def test_no_python_runs(spark):
    docs, _ = _docs(spark)
    plan = fim.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan

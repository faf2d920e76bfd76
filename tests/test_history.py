"""Histories of repositories: objects against the repository's own tool, changes and files by hand, a replay from end to end."""

import os
import subprocess
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from provgraph.functions import enrichment as E
from provgraph.functions.yaml import leaves
from provgraph.operators import enrichers as X
from provgraph.sources import history as H

NOW = datetime(2026, 1, 1, tzinfo=UTC)
PACKAGES = "aboutcode-packages-npm-026/npm/lodash/vulnerabilities.yml"
ADVISORY = "aboutcode-vulnerabilities/11/VCID-1111-2222-3333.yml"


class Repo:
    def __init__(self, path):
        self.path = str(path)
        self.clock = 1_700_000_000
        self.git("init", "-q", "-b", "main", str(path), inside=False)

    def git(self, *args, inside=True):
        env = os.environ | {"GIT_AUTHOR_NAME": "a", "GIT_AUTHOR_EMAIL": "a@b", "GIT_COMMITTER_NAME": "c", "GIT_COMMITTER_EMAIL": "c@d", "GIT_AUTHOR_DATE": f"{self.clock} +0200", "GIT_COMMITTER_DATE": f"{self.clock} +0200", "GIT_CONFIG_GLOBAL": "/dev/null", "HOME": self.path}
        return subprocess.run(["git", *(("-C", self.path) if inside else ()), *args], env=env, check=True, capture_output=True, text=True).stdout.strip()

    def commit(self, files, tick=60):
        self.clock += tick
        for name, content in files.items():
            at = os.path.join(self.path, name)
            if content is None:
                os.remove(at)
                continue
            os.makedirs(os.path.dirname(at), exist_ok=True)
            with open(at, "w") as f:
                f.write(content)
        self.git("add", "-A")
        self.git("commit", "-q", "--allow-empty", "-m", "m\n\nparent " + "0" * 40)
        return self.git("rev-parse", "HEAD")


@pytest.fixture
def tables(spark):
    made = H.Tables(spark)
    yield made
    made.close()


@pytest.fixture
def repo(tmp_path):
    return Repo(tmp_path / "r")


def packages(*vcids, purl="pkg:npm/lodash@4.17.20"):
    listed = "".join(f"    - {v}\n" for v in vcids)
    return f"- purl: pkg:npm/lodash@0.1.0\n  affected_by_vulnerabilities:\n    - VCID-9999-9999-9999\n- purl: {purl}\n  affected_by_vulnerabilities:{' []' if not vcids else ''}\n{listed}  fixing_vulnerabilities: []\n"


def advisory(*aliases, summary="a fault: two\n  lines", score="7.5"):
    return "vulnerability_id: VCID-1111-2222-3333\naliases:\n" + "".join(f"  - {a}\n" for a in aliases) + f"summary: {summary}\nseverities:\n  - score: High\n    scoring_system: cvssv3\n  - score: '{score}'\n    scoring_system: cvssv3.1\n    scoring_elements: CVSS:3.1/AV:N\n  - score: '0.4'\n    scoring_system: epss\nreferences:\n  - url: https://a\n    reference_id:\n  - url: https://b\n"


def grown(n):
    """A long file that changes a little each time, so that packing makes chains of deltas."""
    return "".join(f"line {i} of {n if i == n else 0} {i * i}\n" for i in range(400))


def test_objects_equal_the_tools_own(spark, tables, repo):
    for i in range(12):
        repo.commit({"a/long.txt": grown(i), f"b/{i}.txt": f"{i}"})
    repo.git("repack", "-adfq", "--depth=20")
    repo.git("tag", "-a", "v1", "-m", "t")
    repo.commit({"b/loose.txt": "not packed", "empty.txt": ""})
    found, lost = H.objects(tables, f"{repo.path}/.git")
    wanted = dict(line.split(" ")[:2] for line in repo.git("cat-file", "--batch-all-objects", "--batch-check").split("\n"))
    assert {r["oid"]: r["kind"] for r in found.select("oid", "kind").collect()} == wanted
    assert lost.count() == 0 and found.count() == len(wanted)
    names = [p for p in tables.paths if "/objects-" in p]
    assert len(os.listdir(names[0])) > 3  # chains were there
    texts = {bytes(r["data"]) for r in found.where("kind = 'blob'").collect()}
    assert {grown(i).encode() for i in range(12)} <= texts and b"" in texts


def test_bases_by_name_and_damage(spark, tables, repo, tmp_path):
    for i in range(6):
        repo.commit({"long.txt": grown(i)})
    repo.git("config", "repack.useDeltaBaseOffset", "false")
    repo.git("repack", "-adfq")
    oids = set(repo.git("cat-file", "--batch-all-objects", "--batch-check=%(objectname)").split("\n"))
    found, lost = H.objects(tables, f"{repo.path}/.git")
    assert {r["oid"] for r in found.collect()} == oids and lost.count() == 0
    assert spark.read.parquet(next(p for p in tables.paths if "/entries-" in p)).where("base_oid IS NOT NULL").count() > 0
    bad = tmp_path / "bad" / "objects"
    (bad / "pack").mkdir(parents=True)
    (bad / "00").mkdir()
    pack = next(p for p in (os.path.join(d, f) for d, _, fs in os.walk(repo.path) for f in fs) if p.endswith(".pack"))
    whole = open(pack, "rb").read()
    (bad / "pack" / "pack-1.pack").write_bytes(whole[: len(whole) // 2])
    (bad / "00" / ("0" * 38)).write_bytes(b"nothing")
    part, lost = H.objects(tables, str(tmp_path / "bad"))
    assert {r["oid"] for r in part.collect()} < oids and lost.where("at IS NULL").count() == 2
    assert H.patched(b"abc", b"\x03\x03\x91\x00\x09") is None and H.patched(b"abc", b"\x04\x01") is None and H.patched(None, b"") is None
    assert H.patched(b"abc", b"\x03\x04\x90\x02\x02xy") == b"abxy"


def test_tip_prefers_the_remotes_copy(spark, repo):
    first = repo.commit({"a": "1"})
    second = repo.commit({"a": "2"})
    git = f"{repo.path}/.git"
    assert H.tip(spark, git) == second
    repo.git("update-ref", "refs/remotes/origin/other", first)
    repo.git("symbolic-ref", "refs/remotes/origin/HEAD", "refs/remotes/origin/other")
    assert H.tip(spark, git) == first
    repo.git("update-ref", "refs/remotes/origin/main", second)
    repo.git("pack-refs", "--all")
    assert H.tip(spark, git) == second
    repo.git("checkout", "-q", "--detach", first)
    assert H.tip(spark, git) == first
    empty = Repo(repo.path + "2")
    assert H.tip(spark, f"{empty.path}/.git") is None


def test_walk_changes_and_files(spark, tables, repo):
    one = repo.commit({"d/x": "1", "d/y": "1", "z": "1"})
    two = repo.commit({"d/x": "2"}, tick=0)  # the same second
    repo.git("checkout", "-q", "-b", "side", one)
    side = repo.commit({"d/y": "side", "d/e/f": "deep"})
    repo.git("checkout", "-q", "main")
    three = repo.commit({"z": None, "d/x": "1"})
    repo.git("merge", "-q", "--no-ff", "-m", "merge", "side")
    merge = repo.git("rev-parse", "HEAD")
    last = repo.commit({"d/x": "3"})
    repo.git("checkout", "-q", "-b", "stray", one)
    stray = repo.commit({"q": "1"})
    repo.git("checkout", "-q", "main")
    found, _ = H.objects(tables, f"{repo.path}/.git")
    every = H.commits(found)
    walked = tables.kept(H.reachable(tables, every, last), "walked")
    assert {r["commit"] for r in walked.collect()} == {one, two, side, three, merge, last} and every.count() == 7 and stray
    assert walked.where(F.col("commit") == merge).first()["parents"] == [three, side]
    got = {(r["commit"], r["path"], r["blob"] is None) for r in H.changes(tables, found, walked).collect()}
    assert got == {(one, "d/x", False), (one, "d/y", False), (one, "z", False), (two, "d/x", False), (side, "d/y", False), (side, "d/e/f", False), (three, "z", True), (three, "d/x", False), (last, "d/x", False)}
    narrow = H.changes(tables, found, walked, spark.createDataFrame([("d/x",), ("nowhere/x",), ("d",)], "path string"))
    assert {(r["commit"], r["path"]) for r in narrow.collect()} == {(c, "d/x") for c in (one, two, three, last)}
    asked = [(c, p) for c in (one, two, side, three, merge, last) for p in ("d/x", "d/e/f", "z", "d", "z/x", "nowhere")]
    files = H.blobs_at(tables, found, walked, spark.createDataFrame(asked, "commit string, path string"))
    wanted = {}
    for c, p in asked:
        line = repo.git("ls-tree", c, "--", p).split()
        if line and line[1] == "blob":
            wanted[c, p] = line[2]
    assert {(r["commit"], r["path"]): r["blob"] for r in files.collect()} == wanted


def test_long_histories_are_walked_in_few_rounds(spark, tables):
    """A chain of 600 commits, with a chain of 200 merged into its end."""
    rows = [(f"m{i}", [f"m{i - 1}"] if i else []) for i in range(600)] + [(f"s{i}", [f"s{i - 1}"] if i else ["m3"]) for i in range(200)] + [("top", ["m599", "s199"]), ("stray", ["m5"])]
    every = spark.createDataFrame(rows, "commit string, parents array<string>")
    assert H.reachable(tables, every, "top").count() == 801
    assert len(os.listdir(next(p for p in tables.paths if "/reached-" in p))) < 20
    assert H.reachable(tables, every, "s0").count() == 5 and H.reachable(tables, every, "gone").count() == 0


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("a: 1\nb:\n- x\n- y # c\nc:", {("a",): "1", ("b[]", 0): "x", ("b[]", 1): "y"}),
        ("- p: a: b\n  q: 'it''s'\n- p: \"t\\tu\\u00e9\"\n  r:\n    - - in", {("[].p", 0): "a: b", ("[].q", 0): "it's", ("[].p", 1): "t\tué", ("[].r[][]", 1, 0, 0): "in"}),
        ("s: one\n  two: three\n\n  four\nt: x", {("s",): "one two: three\nfour", ("t",): "x"}),
        ("s: |\n  a\n   b\n\n  c\n\nt: >-\n  d\n  e\nu: |+\n  f\n\n", {("s",): "a\n b\n\nc\n", ("t",): "d e", ("u",): "f\n\n\n"}),
        ("s: 'one\n  two\n\n  three'\nt: \"a\n  b\"", {("s",): "one two\nthree", ("t",): "a b"}),
        ("e: []\nf: [a, b]\nn: ~\no: {}\n---\nv:\n  deep", {("f[]", 0): "a", ("f[]", 1): "b", ("v",): "deep"}),
        ("", {}),
        ("url: http://x/y#z\nd: '2025-11-03 12:55:00+00:00'", {("url",): "http://x/y#z", ("d",): "2025-11-03 12:55:00+00:00"}),
    ],
)
def test_yaml_leaves(text, wanted):
    assert {(p, *at): v for p, at, v in leaves(text)} == wanted


def test_yaml_that_is_not_read():
    for bad in ("a: &x 1", "a: 'open", "a: 1\na: 2", "a: {b: c}", "\ta: 1", 'a: "\\q"', b"\xff"):
        assert leaves(bad) is None
    assert leaves(None) is None
    long = "s: '" + "x\n  " * 200_000 + "y'"
    assert len(leaves(long)[0][2]) == 400_001


def test_paths_of_a_mirror(spark):
    got = spark.range(1).select(*[E.package_path(F.lit(p)) for p in ("pkg:npm/lodash@4.17.20", "pkg:npm/%40angular/core@1", "no")], E.advisory_path(F.lit("VCID-4wn8-fck1-aaaq"))).first()
    assert got[0] == "aboutcode-packages-npm-026/npm/lodash" and got[1].endswith("/npm/@angular/core") and got[2] is None
    assert got[3] == "aboutcode-vulnerabilities/4w/VCID-4wn8-fck1-aaaq.yml"


def test_replay_of_a_repository(spark, tables, repo):
    """Aliases hold as of each commit, also within one second; facts are dated by the advisory's own commits."""
    vcid = "VCID-1111-2222-3333"
    c1 = repo.commit({ADVISORY: advisory("CVE-1"), "README": "r"})
    t1 = repo.clock
    c2 = repo.commit({PACKAGES: packages(vcid)})
    t2 = repo.clock
    c3 = repo.commit({ADVISORY: advisory("CVE-1", "GHSA-2", score="9")}, tick=0)
    c4 = repo.commit({PACKAGES: packages(vcid, "VCID-8888-8888-8888")})
    t4 = repo.clock
    repo.commit({"README": "other"})
    c6 = repo.commit({ADVISORY: None})
    c7 = repo.commit({PACKAGES: packages() + "# &\n"})
    c8 = repo.commit({PACKAGES: "a: &broken 1"})
    repo.git("repack", "-adfq")
    subjects = spark.createDataFrame([("pkg:npm/lodash@4.17.20", "S"), ("pkg:npm/other@1", "O")], "purl string, subject string")
    known = spark.createDataFrame([("cve-1", "V1"), ("ghsa-2", "V2")], "name string, id string")
    read = H.replay(tables, f"{repo.path}/.git", subjects)
    done = X.replayed(read.commits, read.advisories, read.subjects, known, NOW, read.stated)
    seconds = F.unix_seconds("valid_from")
    rows = done.claims.select("subject", "fact", "value", "also", seconds.alias("at")).collect()
    affected = sorted((r["at"], r["subject"], r["value"], *r["also"]) for r in rows if r["fact"] == "affected")
    assert affected == [(t2, "S", vcid, "V1"), (t4, "S", vcid, "V1", "V2"), (t4, "S", "VCID-8888-8888-8888")]
    facts = {(r["at"], r["subject"], r["fact"], r["value"]) for r in rows if r["fact"] != "affected"}
    plain = {("advisory_id", vcid), ("description", "a fault: two lines"), ("cvss_version", "3.1"), ("cvss_vector", "CVSS:3.1/AV:N"), ("epss", "0.4"), ("reference", "https://a"), ("reference", "https://b")}
    wanted = {(t1, "V1", *f) for f in plain | {("cvss", "7.5")}} | {(t2, v, *f) for v in ("V1", "V2") for f in plain | {("cvss", "9")}}
    assert facts == wanted and len(rows) == len(affected) + len(wanted)
    assert {r["commit"] for r in done.commits.collect()} == {c1, c2, c3, c4, c6, c7, c8}
    assert [r["purl"] for r in done.missing.collect()] == ["pkg:npm/other@1"]
    assert [tuple(r) for r in read.unread.collect()] == [(PACKAGES, c8)]


def test_an_empty_repository_has_nothing_to_replay(spark, tables, repo):
    subjects = spark.createDataFrame([("pkg:npm/lodash@4.17.20", "S")], "purl string, subject string")
    read = H.replay(tables, f"{repo.path}/.git", subjects)
    known = spark.createDataFrame([], "name string, id string")
    done = X.replayed(read.commits, read.advisories, read.subjects, known, NOW, read.stated)
    assert done.claims.count() == 0 and done.missing.count() == 1 and done.commits.count() == 0

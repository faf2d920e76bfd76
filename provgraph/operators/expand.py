"""Budgeted expansion: the dependencies of documents' packages, level by level, under one budget for a run.

Fetched dependencies are a table (purl, dep) with a row for each dependency a
package states; a package that states any has a document of its own. A batch's
packages are the roots. Breadth first, each level's new packages are those that
the level before depends on, less all found until then (an anti-join), so that
cycles end and a package counts once, at its smallest level. Levels are written
to the shared folder: a later one never repeats an earlier one's work.

Documents are taken in the order of levels, then of package URLs, until the run's
budget is spent, and none is taken twice in a run. What the budget doesn't allow is
counted, not taken, and the run is marked as exhausted. Documents that can't be
read count as taken and are listed as skipped.

Defined results: null packages and null dependencies are left out; repeated rows
change nothing; a budget of 0 takes nothing and counts all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph import shared


def closure(edges: DataFrame, roots: DataFrame, depth: int | None = None) -> tuple[DataFrame, list[str]]:
    """(purl, level) of all packages that the roots lead to, roots at level 0, at most `depth` levels below; and the paths of its tables."""
    spark = edges.sparkSession
    edges = edges.select("purl", "dep").where("purl IS NOT NULL AND dep IS NOT NULL")
    frontier, path = shared.kept(roots.select("purl").where("purl IS NOT NULL").distinct().withColumn("level", F.lit(0)), "level")
    paths, level = [path], 0
    while depth is None or level < depth:
        level += 1
        found = spark.read.schema(frontier.schema).parquet(*paths)
        reached = frontier.join(edges, "purl").select(F.col("dep").alias("purl")).distinct()
        frontier, path = shared.kept(reached.join(found.select("purl"), "purl", "left_anti").withColumn("level", F.lit(level)), "level")
        paths.append(path)
        if frontier.isEmpty():
            break
    return spark.read.schema(frontier.schema).parquet(*paths), paths


@dataclass(frozen=True)
class Expanded:
    """One batch's documents (purl, level, ok), how many there are, and how many the budget left out."""

    documents: DataFrame
    taken: int
    overflow: int


class Expansion:
    """The budget of a run, and what it was spent on."""

    def __init__(self, edges: DataFrame, limit: int, malformed: DataFrame | None = None, depth: int | None = None):
        """`malformed` has the purls whose documents can't be read."""
        if limit < 0:
            raise ValueError("a budget is a number of documents")
        self.edges, self.limit, self.malformed, self.depth = edges, limit, malformed, depth
        self.used = self.overflow = 0
        self._taken: list[str] = []

    @property
    def exhausted(self) -> bool:
        """Whether the budget has left a document out."""
        return self.overflow > 0

    def taken(self) -> DataFrame:
        """(purl, level, ok) of all documents taken in this run."""
        spark = self.edges.sparkSession
        return spark.read.schema(_TAKEN).parquet(*self._taken) if self._taken else spark.createDataFrame([], _TAKEN)

    def expand(self, roots: DataFrame) -> Expanded:
        """Take the documents that a batch's packages lead to, as far as the budget goes."""
        spark = self.edges.sparkSession
        reached, paths = closure(self.edges, roots, self.depth)
        stated = self.edges.where("dep IS NOT NULL").select("purl").distinct()
        fresh = reached.join(stated, "purl", "left_semi").join(self.taken().select("purl"), "purl", "left_anti")
        bad = F.lit(None).cast("string").alias("bad")
        ok = fresh.select("*", bad) if self.malformed is None else fresh.join(self.malformed.select(F.col("purl").alias("bad")).distinct(), F.col("purl") == F.col("bad"), "left")
        ready, path = shared.kept(ok.select("purl", "level", F.col("bad").isNull().alias("ok")), "expansion")
        total = ready.count()
        room = self.limit - self.used
        # Only a batch that has more than the budget allows is put in order, and no more of it than is taken.
        documents = ready if total <= room else ready.orderBy("level", "purl").limit(room)
        documents, kept = shared.kept(documents, "expanded")
        self._taken.append(kept)
        found = Expanded(documents, min(total, room), max(0, total - room))
        self.used += found.taken
        self.overflow += found.overflow
        shared.removed(spark, path, *paths)
        return found

    def skipped(self) -> DataFrame:
        """Package URLs of the documents that were taken but can't be read."""
        return self.taken().where("NOT ok").select("purl")

    def dependencies(self) -> DataFrame:
        """(purl, dep) as the documents taken state them."""
        return self.edges.where("dep IS NOT NULL").distinct().join(self.taken().where("ok").select("purl"), "purl", "left_semi")

    def close(self) -> None:
        """Remove the run's tables."""
        shared.removed(self.edges.sparkSession, *self._taken)
        self._taken = []


_TAKEN = "purl string, level int, ok boolean"

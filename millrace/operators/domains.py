"""The closest value of a domain too large for one expression: a table of neighbourhoods and an equi-join.

A value may differ from a text in some edits, the more the longer it is. It is cut into half as many parts as edits
are allowed, and one: then some part differs in one edit at most, and two such strings have a variant in common, one
of them with a letter left out or as it is. Variants of the parts of all values are the index; texts look up the
variants of those of their pieces that can stand where a part stands. Exact distances are computed of what is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import catalog as C
from millrace.functions import text

_FOUND = "__closest"


def fold(value: Column) -> Column:
    """Lower-case without white space, as values are compared."""
    return F.regexp_replace(F.lower(value), f"[{text.WS}]+", "")


def _variants(part: Column) -> Column:
    """A string and all strings with one of its letters left out."""
    n = F.length(part)
    shorter = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(part, 1, i - 1), F.substring(part, i + 1, n)))
    return F.array_distinct(F.when(n > 0, F.concat(F.array(part), shorter)).otherwise(F.array(part)))


def _parts(length: Column, edits: Column) -> Column:
    """(number, start, n) of the parts of a value of a length, from 0."""
    count = F.floor(edits / 2).cast("int") + 1
    start = lambda j: F.floor(j * length / count).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda j: F.struct(j.alias("number"), start(j).alias("start"), (start(j + 1) - start(j)).alias("n")),
    )


class DomainIndex:
    """The neighbourhoods of a domain's values.

    ``values`` holds the domain in ``column``; its order for ties is that of ``order``. A null value is none. The
    index can be written as a table and used again.
    """

    def __init__(self, values: DataFrame, column: str, order: str, similarity: float = C.STATUS_SIMILARITY):
        folded = fold(F.col(column))
        self.values = values.where(F.col(column).isNotNull()).select(
            F.col(column).alias("value"), F.col(order).alias("place"), folded.alias("folded"), F.length(folded).alias("length")
        )
        self.similarity = similarity
        self._edits = lambda length: F.floor(length * F.lit(similarity)).cast("int")
        parts = self.values.select("place", "folded", "length", F.explode(_parts(F.col("length"), self._edits(F.col("length")))).alias("part"))
        own = F.substring(F.col("folded"), F.col("part.start") + 1, F.col("part.n"))
        self.table = parts.select("place", "length", F.col("part.number").alias("number"), F.explode(_variants(own)).alias("variant"))

    def _probes(self, texts: DataFrame) -> DataFrame:
        """(t, length, number, variant) of every distinct text, for each length that a value within reach can have."""
        # One number for each length of a value.
        lengths = sorted(r["length"] for r in self.values.select("length").distinct().collect())
        if not lengths:
            return texts.select("t", F.lit(0).alias("length"), F.lit(0).alias("number"), F.lit("").alias("variant")).limit(0)
        n = F.length("t")
        reach = F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: F.abs(x - n) <= self._edits(x))
        placed = texts.select("t", F.explode(reach).alias("length")).withColumn("edits", self._edits(F.col("length")))
        placed = placed.select("t", "length", "edits", F.explode(_parts(F.col("length"), F.col("edits"))).alias("part"))
        first = F.greatest(F.lit(0), F.col("part.start") - F.col("edits"))
        last = F.least(n, F.col("part.start") + F.col("edits"))
        placed = placed.where(first <= last).select("t", "length", "part", F.explode(F.sequence(first, last)).alias("start"))
        pieces = placed.select("t", "length", "part", "start", F.explode(F.array(*[F.col("part.n") + d for d in (-1, 0, 1)])).alias("n"))
        pieces = pieces.where((F.col("n") >= 0) & (F.col("start") + F.col("n") <= n))
        piece = F.substring(F.col("t"), F.col("start") + 1, F.col("n"))
        own = pieces.select("t", "length", F.col("part.number").alias("number"), piece.alias("piece")).distinct()
        return own.select("t", "length", "number", F.explode(_variants(F.col("piece"))).alias("variant")).distinct()

    def closest(self, texts: DataFrame) -> DataFrame:
        """(t, value, distance) for the distinct folded texts ``t`` that have a value within reach; the first of equal ones."""
        found = self._probes(texts).join(self.table, ["length", "number", "variant"]).select("t", "place").distinct()
        near = found.join(self.values, "place").withColumn("distance", F.levenshtein("t", "folded"))
        near = near.where(F.col("distance") <= self._edits(F.col("length")))
        best = near.groupBy("t").agg(F.min(F.struct("distance", "place", "value")).alias("best"))
        return best.select("t", F.col("best.value").alias("value"), F.col("best.distance").alias("distance"))


def add_closest(df: DataFrame, column: str, index: DomainIndex, name: str) -> DataFrame:
    """All rows with the closest value of the domain in ``name``; null for a null, or where none is near enough.

    Each distinct text is looked up once, however many rows have it.
    """
    marked = df.withColumn(_FOUND, fold(F.col(column)))
    texts = marked.where(F.col(_FOUND).isNotNull()).select(F.col(_FOUND).alias("t")).distinct()
    best = index.closest(texts).select(F.col("t").alias(_FOUND), F.col("value").alias(name))
    return marked.join(best, _FOUND, "left").select(*df.columns, name)

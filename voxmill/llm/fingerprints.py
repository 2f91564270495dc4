"""Document fingerprints by Order MinHash.

A text's k-mers are pairs of neighbouring words (parts between spaces); a text of one word has one k-mer. Every k-mer carries its
occurrence number, so that repetitions count. A hash of (k-mer, occurrence) deals them into
``CELLS`` cells; each cell keeps its ``PICK`` smallest, puts them back into text order and hashes
the tuple. Moving, replacing or swapping words changes the tuples, so the share of equal cells
falls with the edit distance, not only with the sets of words.

Everything is array functions on one row: no explode, no shuffle for the fingerprint itself. Null
texts count as empty; an empty text has one empty k-mer. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CELL_BITS = 5
CELLS = 1 << CELL_BITS
PICK = 2
_PLACE_BITS = 30  # a text has fewer than 2 ** 30 words, as it has fewer than 2 ** 31 bytes
_PLACE = (1 << _PLACE_BITS) - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _packed(hash_: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftright(hash_, _PLACE_BITS), _PLACE_BITS).bitwiseOR(place.cast("long"))


def _run_starts(values: Column, n: Column, bits: int) -> Column:
    """Places at which the high part of the sorted ``values`` changes."""
    high = lambda i: F.shiftright(F.get(values, i), bits)
    return F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (high(i) != high(i - 1)))


def cells(text: Column) -> Column:
    """The fingerprint as an array of CELLS strings of eight hex digits, null where a cell is empty."""

    def of_words(words: Column) -> Column:
        n = F.greatest(F.size(words) - 1, F.lit(1))
        hashes = F.transform(
            F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1))
        )
        return _let(hashes, of_hashes)

    def of_hashes(hashes: Column) -> Column:
        return _let(F.sort_array(F.transform(hashes, _packed)), lambda s: numbered(hashes, s))

    def numbered(hashes: Column, by_kmer: Column) -> Column:
        n = F.size(by_kmer)

        def occurrences(starts: Column) -> Column:
            return F.flatten(F.transform(starts, lambda a, j: F.sequence(
                F.lit(0), F.coalesce(F.get(starts, j + 1), n) - a - 1
            )))

        order = F.zip_with(
            by_kmer, _let(_run_starts(by_kmer, n, _PLACE_BITS), occurrences),
            lambda x, o: _packed(
                F.xxhash64(F.shiftright(x, _PLACE_BITS), o), x.bitwiseAND(F.lit(_PLACE))
            ),
        )
        return _let(F.sort_array(order), lambda v: dealt(hashes, v))

    def dealt(hashes: Column, order: Column) -> Column:
        cell_of = lambda x: F.shiftright(x, 64 - CELL_BITS)

        def tuple_hash(start: Column) -> Column:
            first = F.get(order, start)
            picked = F.filter(
                F.slice(order, start + 1, F.lit(PICK)), lambda x: cell_of(x) == cell_of(first)
            )
            places = F.sort_array(F.transform(picked, lambda x: x.bitwiseAND(F.lit(_PLACE)).cast("int")))
            return F.struct(
                cell_of(first).cast("int").alias("cell"),
                F.lower(F.lpad(F.hex(F.shiftrightunsigned(
                    F.xxhash64(F.transform(places, lambda p: F.get(hashes, p))), 32
                )), 8, "0")).alias("hash"),
            )

        filled = F.transform(_run_starts(order, F.size(order), 64 - CELL_BITS), tuple_hash)
        half = CELLS // 2
        return _let(F.map_from_entries(filled), lambda m: F.transform(
            F.sequence(F.lit(-half), F.lit(half - 1)), lambda c: F.try_element_at(m, c)
        ))

    return _let(F.split(F.coalesce(text, F.lit("")), " "), of_words)


def as_text(fingerprint: Column) -> Column:
    return F.array_join(fingerprint, "", "--------")


def likeness(left: Column, right: Column) -> Column:
    """Equal cells as a share of those filled on either side."""
    both = F.zip_with(left, right, lambda a, b: F.when(
        a.isNotNull() | b.isNotNull(), F.when(a == b, 1).otherwise(0)
    ))
    return F.aggregate(
        F.filter(both, lambda x: x.isNotNull()),
        F.struct(F.lit(0.0).alias("same"), F.lit(0.0).alias("all")),
        lambda a, x: F.struct((a["same"] + x).alias("same"), (a["all"] + 1.0).alias("all")),
        lambda a: a["same"] / a["all"],
    )


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` plus ``fingerprint`` (string). No shuffle."""
    return docs.select(*keep, as_text(cells(F.col(text))).alias("fingerprint"))


def _ranges(docs: DataFrame, count: int) -> DataFrame:
    """``docs`` with ``_range``: a number that rises with ``doc_id``; nulls come last."""
    steps = [i / count for i in range(1, count)]
    found = docs.agg(
        F.percentile_approx(F.col("doc_id").cast("double"), steps, count * 20).alias("at")
    ).first()["at"] or []
    splits = [float("-inf"), *(sorted(set(found)) or [0.0]), float("inf")]
    made = Bucketizer(splits=splits, inputCol="_double", outputCol="_range", handleInvalid="keep")
    ranged = made.transform(docs.withColumn("_double", F.col("doc_id").cast("double")))
    return ranged.withColumn("_range", F.coalesce("_range", F.lit(float(count)))).drop("_double")


def with_next(docs: DataFrame, count: int) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``next``: a struct of the row that follows by doc_id.

    The last row is followed by the first. Rows are sorted within ranges of ``doc_id``; a copy of
    each range's first row goes to the range before it. Equal doc_ids are ordered by text.
    """
    names = docs.columns
    ranged = _ranges(docs, count)
    starts = sorted(
        ranged.select("_range", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id").alias("id"))
        .groupBy("_range").agg(F.min("id").alias("first")).collect()
    )  # at most count + 1 rows
    turn = [
        (row["_range"], starts[i - 1]["_range"], row["first"]["doc_id"]) for i, row in enumerate(starts)
    ]
    spark = docs.sparkSession
    turns = spark.createDataFrame(turn, "_range double, _before double, _first long")
    placed = ranged.join(F.broadcast(turns), "_range").withColumn("_place", F.explode(F.when(
        F.col("doc_id").eqNullSafe(F.col("_first")),
        F.array(
            F.struct(F.col("_range").alias("to"), F.lit(0).alias("guest")),
            F.struct(F.col("_before").alias("to"), F.lit(1).alias("guest")),
        ),
    ).otherwise(F.array(F.struct(F.col("_range").alias("to"), F.lit(0).alias("guest"))))))
    order = W.partitionBy("_to").orderBy("_guest", F.asc_nulls_last("doc_id"), "text")
    return (
        placed.select(*names, F.col("_place.to").alias("_to"), F.col("_place.guest").alias("_guest"))
        .withColumn("next", F.lead(F.struct(*names)).over(order))
        .where("_guest = 0").drop("_to", "_guest")
    )


def query(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of the text with its last quarter taken from the next one."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("cells", cells(F.col("text")))
    rows = with_next(rows, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - cut), F.substring(F.col("next.text"), F.lit(1), cut)
    )
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "cells",
        F.col("next.cells").alias("next_cells"),
    )
    rows = rows.withColumn("edited_cells", cells(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("cells")).alias("fingerprint"),
        as_text(F.col("edited_cells")).alias("edited_fingerprint"),
        likeness(F.col("cells"), F.col("edited_cells")).alias("near_edited"),
        likeness(F.col("cells"), F.col("next_cells")).alias("near_next"),
    )

"""Lines that many documents share: dropped by keep bitmaps, in DataFrame functions alone.

Each line becomes a 96-bit hash of its key. The hash space is cut into equal ranges; the lines are
dealt out by range with a secondary sort by document and position, and one pass over each key's sorted
lines streams the first line of every document, so a running count of those is the number of documents.
What comes back is a bitmap per document: the run-length coded positions at which "kept" flips. Texts
are read again where the bitmap is applied; they never travel with the hashes.

A key that a third of all documents hold would be one long run in one task. An exact histogram of the
ranges (at most 65,536 counts) shows such ranges; they are cut into slices of documents, whose counts
are added up per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import materialize

#: The key is the line without these at both ends, A-Z lower-cased (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The leading bits of a hash that number its range: 65,536 ranges.
RANGE_BITS = 16
#: A range of more lines than this, and than four average ranges, is cut into slices of documents.
SLICE_LINES = 2_000


def split_lines(text: Column) -> Column:
    """The parts of a text between line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def identity(id_col: str, text_col: str) -> Column:
    """A hash of id and text. Rows that share it are copies of one row and get the same bitmap."""
    return F.xxhash64(F.lit("row"), F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def line_keys(docs: DataFrame, least_length: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(span, hash, check, id, row, pos) of every line whose key has ``least_length`` code points or more."""
    lines = docs.select(F.col(id_col).cast("long").alias("id"), identity(id_col, text_col).alias("row"),
                        F.posexplode(split_lines(F.translate(F.col(text_col).cast("string"), UPPER, LOWER))).alias("pos", "line"))
    keys = lines.select("id", "row", "pos", F.btrim("line", F.lit(BLANKS)).alias("key")).filter(F.char_length("key") >= least_length)
    hashed = keys.select(F.xxhash64("key").alias("hash"), F.hash("key").alias("check"), "id", "row", "pos")
    return hashed.select(F.shiftrightunsigned("hash", 64 - RANGE_BITS).alias("span"), "*")


def crowded_spans(lines: DataFrame, slice_lines: int = SLICE_LINES) -> dict[int, int]:
    """Slices of each range that is too large for one task; at most 65,536 counts reach the driver."""
    counts = {r["span"]: r["count"] for r in lines.groupBy("span").count().collect()}
    most = max(slice_lines, 4 * sum(counts.values()) // (1 << RANGE_BITS))
    return {span: -(-n // most) for span, n in counts.items() if n > most}


def _streamed(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Lines by range, sorted by key, document and position: ``opens`` marks a document's first line of the key,
    ``nth`` counts the key's lines and ``n_docs`` its documents, in this range and slice."""
    by_key = Window.partitionBy(*keys)
    in_order = by_key.orderBy(F.col("id").asc_nulls_last(), "row", "pos")
    sorted_lines = lines.repartition(*keys[:-2]).sortWithinPartitions(*keys, F.col("id").asc_nulls_last(), "row", "pos")
    nth = sorted_lines.withColumn("nth", F.row_number().over(in_order)).withColumn("previous", F.lag("id").over(in_order))
    opens = nth.withColumn("opens", ((F.col("nth") == 1) | ~F.col("id").eqNullSafe(F.col("previous"))).cast("long")).drop("previous")
    return opens.withColumn("n_docs", F.sum("opens").over(by_key))


def dropped_lines(docs: DataFrame, least_docs: int = 10, least_length: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text",
                  slice_lines: int = SLICE_LINES) -> DataFrame:
    """(id, row, pos) of the lines whose key is in ``least_docs`` documents or more.

    Rows with one id are one document, and so are all rows with a null id. ``keep_first`` spares the first
    line of each key by id (null last), ``row`` and position; in copies of that row as well.
    """
    lines = materialize(line_keys(docs, least_length, id_col, text_col), "line-keys")  # read for the histogram, then dealt out
    slices = crowded_spans(lines, slice_lines)
    crowded = F.broadcast(docs.sparkSession.createDataFrame(list(slices.items()), "span long, n_slices int"))  # under a quarter of the 65,536 ranges
    whole = _streamed(lines.join(crowded, "span", "left_anti") if slices else lines, ["span", "hash", "check"]).filter(F.col("n_docs") >= least_docs)
    found = (whole.filter("nth > 1") if keep_first else whole).select("id", "row", "pos")
    if not slices:
        return found
    cut = lines.join(crowded, "span").withColumn("slice", F.pmod(F.xxhash64("id", F.lit("slice")), F.col("n_slices")))
    key = ["span", "hash", "check"]
    parts = _streamed(cut, ["span", "slice", "hash", "check"])
    where = F.struct(F.col("id").isNull().alias("none"), "id", "row", "pos")
    # One row per key and slice, however many lines it has; the totals go back to every slice of the key.
    sums = parts.filter("nth = 1").groupBy(*key).agg(F.sum("n_docs").alias("total"), F.min(where).alias("start"), F.collect_list("slice").alias("slices"))
    common = sums.filter(F.col("total") >= least_docs).select(*key, F.explode("slices").alias("slice"), "start")
    rest = cut.join(common, [*key, "slice"])
    if keep_first:
        rest = rest.filter(~((F.col("row") == F.col("start")["row"]) & (F.col("pos") == F.col("start")["pos"])))
    return found.unionByName(rest.select("id", "row", "pos"))


def keep_bitmaps(docs: DataFrame, least_docs: int = 10, least_length: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text",
                 slice_lines: int = SLICE_LINES) -> DataFrame:
    """(id, row, n_dropped, flips) of every document that loses a line.

    ``flips`` is its keep bitmap, run-length coded: kept lines come first, and at each position in it
    "kept" turns to "dropped" or back. ``row`` is ``identity``. A null or empty text is one empty line,
    whose key is shorter than ``least_length``, as is that of blanks. Copies of a row share one bitmap,
    an empty table has none, and columns other than the two named are not looked at.
    """
    found = dropped_lines(docs, least_docs, least_length, keep_first, id_col, text_col, slice_lines)
    at = F.col("at")
    after = F.transform(at, lambda p: p + 1)
    flips = F.array_sort(F.concat(F.array_except(at, after), F.array_except(after, at)))
    return found.groupBy("id", "row").agg(F.collect_set("pos").alias("at")).select("id", "row", F.size("at").cast("long").alias("n_dropped"), flips.alias("flips"))


def kept_text(text: Column, flips: Column) -> Column:
    """The lines that a bitmap keeps, joined by line feeds: whole runs are taken, not line by line."""
    lines = split_lines(text)
    bounds = F.concat(F.array(F.lit(0)), flips, F.array(F.size(lines)))
    runs = F.transform(F.sequence(F.lit(0), F.size(flips), F.lit(2)),
                       lambda i: F.slice(lines, F.element_at(bounds, i + 1) + 1, F.element_at(bounds, i + 2) - F.element_at(bounds, i + 1)))
    return F.array_join(F.flatten(runs), "\n")


def remove_common_lines(docs: DataFrame, least_docs: int = 10, least_length: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text",
                        slice_lines: int = SLICE_LINES) -> DataFrame:
    """(doc, n_lines, n_dropped, kept): each row of ``docs`` as a struct, its lines, those dropped and what is left of its text.

    One row out per row in, repeated rows and null ids included; see ``keep_bitmaps`` for what is dropped.
    """
    bitmaps = keep_bitmaps(docs, least_docs, least_length, keep_first, id_col, text_col, slice_lines)
    marks = bitmaps.select(F.col("id").alias("mark_id"), F.col("row").alias("mark_row"), "n_dropped", "flips")
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"), identity(id_col, text_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    joined = rows.join(marks, (F.col("row") == F.col("mark_row")) & F.col("id").eqNullSafe(F.col("mark_id")), "left")
    text = F.coalesce("text", F.lit(""))
    kept = F.when(F.col("flips").isNull(), text).otherwise(kept_text(F.col("text"), F.col("flips")))
    n_lines = F.length(text) - F.length(F.translate(text, "\n", "")) + 1
    return joined.select("doc", n_lines.cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))

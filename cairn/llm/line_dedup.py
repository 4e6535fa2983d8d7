"""Line dedup: range-partitioned line hashes, streamed in order, give a compressed keep bitmap per document.

Only DataFrame functions. A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Its two
64-bit hashes are range-partitioned and sorted by document (largest first) and position, so the first row of a run is
the line to keep and one pass over the run counts its documents. Keys that are frequent in a sample never form a run:
their documents are counted by aggregates that combine before the shuffle, and the totals (at most ``HOT_KEYS`` rows)
are broadcast to the lines where they lie. The sample only chooses the way; either way gives the same rows.

Defined results: null or empty text is one empty line; a null ``doc_id`` neither counts as a document nor loses lines;
rows that repeat a ``doc_id`` count as one document (each text has its own bitmap); equal lines of one document stay
or go together; extra columns pass through ``drop_lines`` untouched, but for those named like its two counts: these are replaced.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.names import free_names
from cairn.llm.store import shuffle_slots, stored

MIN_CHARS = 40
MIN_DOCS = 5
BLANK = " \t\n\x0b\x0c\r"
#: sampled share of lines, and the sampled hits from which on a key counts as frequent (at most HOT_KEYS of them)
SAMPLE, HOT_HITS, HOT_KEYS = 0.01, 25, 10_000


def line_key(line: Column) -> Column:
    """Trimmed, A-Z lower-cased. ``lower`` is right for lines of single-byte characters and much faster."""
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def text_id(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row per line with a key of at least ``min_chars`` code points."""
    lines = docs.where(F.col("doc_id").isNotNull() & (F.char_length("text") >= min_chars)).select(
        "doc_id", text_id(F.col("text")).alias("_text_id"), F.posexplode(F.split("text", "\n")).alias("_pos", "_line"))
    keyed = lines.select("doc_id", "_text_id", "_pos", line_key(F.col("_line")).alias("_key"))
    return keyed.where(F.char_length("_key") >= min_chars).select(
        F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(41), F.col("_key")).alias("_h2"), "doc_id", "_text_id", "_pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text_id, n_dropped, dropped``: only documents that lose lines.

    ``dropped`` is the compressed bitmap, a map from ``position div 64`` to the 64 bits of that word; words whose lines
    all stay are not stored.
    """
    lines = stored(hashed_lines(docs, min_chars), "lines")
    hot = F.broadcast(lines.sample(SAMPLE, seed=7).groupBy("_h1", "_h2").count().where(F.col("count") >= HOT_HITS)
                      .orderBy(F.desc("count"), "_h1", "_h2").limit(HOT_KEYS).select("_h1", "_h2"))
    run = Window.partitionBy("_h1", "_h2")
    new_doc = F.coalesce(F.lag("doc_id").over(run.orderBy(F.desc("doc_id"), "_pos")) != F.col("doc_id"), F.lit(True))
    streamed = (lines.join(hot, ["_h1", "_h2"], "left_anti").repartitionByRange(shuffle_slots(docs), "_h1", "_h2")
                .withColumn("_new", new_doc.cast("int"))
                .withColumns({"_first": F.max("doc_id").over(run), "_docs": F.sum("_new").over(run)}).drop("_new"))
    frequent = lines.join(hot, ["_h1", "_h2"], "left_semi")
    totals = (frequent.groupBy("_h1", "_h2", "doc_id").agg(F.lit(1).alias("_one"))
              .groupBy("_h1", "_h2").agg(F.max("doc_id").alias("_first"), F.count("*").alias("_docs")))
    counted = streamed.unionByName(frequent.join(F.broadcast(totals), ["_h1", "_h2"]))
    gone = counted.where((F.col("_docs") >= min_docs) & (F.col("doc_id") != F.col("_first")))
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("_pos"), F.lit(64)).cast("int")))
    return (gone.repartition("doc_id", "_text_id")
            .groupBy("doc_id", "_text_id", F.floor(F.col("_pos") / 64).cast("int").alias("_word")).agg(bits.alias("_bits"))
            .groupBy("doc_id", "_text_id").agg(
                F.sum(F.bit_count("_bits")).alias("n_dropped"),
                F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("dropped"))
            .withColumnRenamed("_text_id", "text_id"))


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines that a bitmap keeps, joined by ``\\n``."""
    whole = F.coalesce(text, F.lit(""))

    def stays(line: Column, place: Column) -> Column:
        word = F.coalesce(F.try_element_at(dropped, F.floor(place / 64).cast("int")), F.lit(0).cast("long"))
        return F.call_function("getbit", word, F.pmod(place, F.lit(64)).cast("int")) == 0

    return F.when(dropped.isNull(), whole).otherwise(F.array_join(F.filter(F.split(whole, "\n"), stays), "\n"))


def drop_lines(docs: DataFrame, bitmaps: DataFrame | None = None, counts: tuple[str, str] = ("n_lines", "n_dropped"), **limits) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``, plus the two ``counts``: lines before, and lines dropped."""
    bitmaps = keep_bitmaps(docs, **limits) if bitmaps is None else bitmaps
    docs = docs.drop(*counts)
    own, doc, tid, gone, dropped = free_names(docs, "_own", "_doc", "_tid", "_gone", "_dropped")
    marks = bitmaps.select(F.col("doc_id").alias(doc), F.col("text_id").alias(tid),
                           F.col("n_dropped").alias(gone), F.col("dropped").alias(dropped))
    joined = docs.withColumn(own, text_id(F.col("text"))).join(
        marks.hint("shuffle_hash"), (F.col("doc_id") == F.col(doc)) & (F.col(own) == F.col(tid)), "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    return joined.withColumns({
        counts[0]: F.size(F.split(text, "\n")).cast("long"), counts[1]: F.coalesce(gone, F.lit(0)).cast("long"),
        "text": kept_text(F.col("text"), F.col(dropped))}).drop(own, doc, tid, gone, dropped)

"""Removal of lines that many documents share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bit_words, bits_for, materialize, with_bit
from .tokens import texts_in

BLANK = b" \t\n\x0b\x0c\r"
#: The filter of documents that lose lines has at most 2**24 bits (262,144 rows of 16 bytes).
MOST_BITS = 24


def _lines(least_length: int):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_in(batches, "_text"):
            row, pos, hi, lo = [], [], [], []
            for i, text in enumerate(texts):
                for p, line in enumerate((text or b"").lower().split(b"\n")):
                    key = line.strip(BLANK)
                    if len(key) >= least_length and (len(key) >= 4 * least_length or len(key.decode("utf-8", "replace")) >= least_length):
                        h = xxhash.xxh3_128_intdigest(key)
                        row.append(i)
                        pos.append(p)
                        hi.append(h >> 64)
                        lo.append(h & 0xFFFFFFFFFFFFFFFF)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(take), batch.column("_row").take(take), pa.array(pos, pa.int32()),
                 pa.array(np.array(hi, np.uint64).view(np.int64)), pa.array(np.array(lo, np.uint64).view(np.int64))],
                names=["_id", "_row", "_pos", "_hi", "_lo"],
            )

    return explode


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]))
def _rebuild(text, drop):
    import pandas as pd

    out = []
    for t, d in zip(text, drop, strict=True):
        lines = (t or "").split("\n")
        gone = set() if d is None else set(map(int, d))
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t or "", len(lines), len(gone)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_docs: int = 2, least_length: int = 10) -> DataFrame:
    """Drops the lines whose key occurs in at least `least_docs` documents, except in the
    document with the smallest id.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased; keys of fewer
    than `least_length` code points count for nothing.  Lines are exploded with their position,
    hashed (128 bits), and the documents of each hash are counted with partial aggregation; lines
    to drop come from a join of two written tables, whose hot keys Spark can split.  A text is
    shuffled only if its document may lose a line (a bit filter of bounded size tells); the
    others are final in the scan.

    Returns id, text (null as empty), n_lines, n_dropped for each input row.  Null or empty text is
    one empty line.  A document is all rows with one id: rows that repeat an id don't count
    twice, and each keeps or loses its lines by itself.  Rows without an id are left as they
    are and don't count.  A document whose lines all go has an empty text.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    row = F.xxhash64("_text")  # tells apart rows that repeat an id
    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType), T.StructField("_row", T.LongType()), T.StructField("_pos", T.IntegerType()), T.StructField("_hi", T.LongType()), T.StructField("_lo", T.LongType())])
    lines = materialize(rows.where("_id IS NOT NULL").withColumn("_row", row).mapInArrow(_lines(least_length), schema), "lines")
    if least_docs <= 2:
        held = lines.groupBy("_hi", "_lo").agg(F.min("_id").alias("_owner"), F.max("_id").alias("_last")).where("_owner < _last")
    else:
        once = lines.select("_hi", "_lo", "_id").distinct()
        held = once.groupBy("_hi", "_lo").agg(F.min("_id").alias("_owner"), F.count("*").alias("_n")).where(F.col("_n") >= least_docs)
    held = materialize(held.select("_hi", "_lo", "_owner"), "held")
    extra = lines.join(held, ["_hi", "_lo"]).where("_id > _owner").select(F.col("_id").alias("_did"), F.col("_row").alias("_drow"), "_pos")
    drops = materialize(extra.groupBy("_did", "_drow").agg(F.collect_set("_pos").alias("_drop")), "drops")
    bits = bits_for(drops.count(), MOST_BITS)
    words = bit_words(drops.select(F.xxhash64("_did", "_drow").alias("_h")), "_h", bits)
    known = with_bit(rows.withColumn("_row", row), F.xxhash64("_id", "_row"), words, bits, "_loses")
    whole = F.coalesce("_text", F.lit(""))
    clean = known.where("NOT _loses").select(F.col("_id").alias(id_col), whole.alias("text"), F.size(F.split(whole, "\n", -1)).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))
    some = known.where("_loses").join(drops, (F.col("_id") == F.col("_did")) & (F.col("_row") == F.col("_drow")), "left").select("_id", _rebuild("_text", "_drop").alias("_new"))
    return clean.unionByName(some.select(F.col("_id").alias(id_col), "_new.text", "_new.n_lines", "_new.n_dropped"))

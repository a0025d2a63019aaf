"""Token counts from an exact histogram of encoded lengths.

Each whole text is encoded in the tasks; only its length leaves them, and lengths are counted
before they are shuffled. The histogram has one row for each length that occurs, and sums over
it answer, exactly and for every context limit, how many tokens there are, how many are left
when each document is cut at the limit, and which share of documents fits.

The vocabulary is a file of ranks that every executor can read at the same path.

The pattern's rule for blanks looks ahead at every one of them, more than its engine can do on
a run of a million. Long runs are therefore cut where the pattern cuts them anyway: all blanks of
a run but the last are one piece, the last belongs to what follows.

Defined results: texts are encoded whole, whatever their length. Null and empty texts have length 0 and count as documents. Control strings in
a text are ordinary text. Repeated rows each count. An empty table has an empty histogram, and
no quantiles. Other columns are ignored, or group the histogram.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthtide.llm.frames import seal
from monthtide.llm.words import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: how this vocabulary's texts are cut before pairs are merged.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


# Fixed value: what the pattern takes for a blank.
BLANK = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
LONG_RUN = 1_000


def encoded_length(coder, text: str, long_run: int = LONG_RUN) -> int:
    """The number of tokens of a text."""
    total, start = 0, 0
    for run in re.finditer(f"{BLANK}{{{long_run},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(coder.encode_ordinary(text[start : run.start()]))
        total += len(coder._encode_single_piece(text[run.start() : end]))
        start = end
    return total + len(coder.encode_ordinary(text[start:]))


def encoding(path: str, pattern: str):
    """The encoding of a file of ranks; a worker reads it once, whatever the number of tasks."""
    import tiktoken
    from tiktoken.registry import ENCODINGS

    name = f"{path}\n{pattern}"
    if name not in ENCODINGS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        ENCODINGS[name] = tiktoken.Encoding(
            name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return ENCODINGS[name]


def encoded_lengths(
    docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN
) -> DataFrame:
    """``docs`` under internal column names, without the text, and ``length`` in tokens."""
    sealed = seal(docs)
    text = sealed.column(text_col)
    frame = sealed.frame.withColumn("_text", F.col(text).cast("string")).drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(vocabulary, pattern)
        for part in slices(batches, "_text"):
            texts = part.column("_text").to_pylist()
            lengths = np.array([encoded_length(coder, t) if t else 0 for t in texts], np.int64)
            kept = part.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(lengths)], [*kept.schema.names, "length"]
            )

    fields = [f for f in frame.schema.fields if f.name != "_text"]
    return frame.mapInArrow(run, T.StructType([*fields, T.StructField("length", T.LongType())]))


def length_histogram(
    docs: DataFrame, text_col: str = "text", by: Sequence[str] = (), **encoding_options
) -> DataFrame:
    """A row for each length that occurs (in each group of ``by``): length, documents, and sums.

    tokens: those of the documents of that length. longer: documents that are longer. share:
    of the documents that are no longer. total: tokens of all documents. truncated_total: what
    is left of them if each document is cut at this length.
    """
    rows = docs.select(*by, F.col(text_col).alias("text"))
    lengths = encoded_lengths(rows, "text", **encoding_options)
    groups = [f"_c{i}" for i in range(len(by))]
    counted = lengths.groupBy(*groups, "length").agg(F.count(F.lit(1)).alias("documents"))
    counted = counted.withColumn("tokens", F.col("length") * F.col("documents"))
    # one row for each length: as many as the longest document has tokens, at most
    up = Window.partitionBy(*groups).orderBy("length")
    whole = Window.partitionBy(*groups)
    shorter = F.sum("tokens").over(up)
    longer = F.sum("documents").over(whole) - F.sum("documents").over(up)
    return counted.select(
        *[F.col(g).alias(name) for g, name in zip(groups, by)],
        "length",
        "documents",
        "tokens",
        longer.alias("longer"),
        (F.sum("documents").over(up) / F.sum("documents").over(whole)).alias("share"),
        F.sum("tokens").over(whole).alias("total"),
        (shorter + F.col("length") * longer).alias("truncated_total"),
    )


def length_quantiles(histogram: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """quantile, length: the least length such that this share of the documents is no longer."""
    asked = histogram.select(
        "length", "share", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])).alias("quantile")
    )
    return asked.where("share >= quantile").groupBy("quantile").agg(F.min("length").alias("length"))


def truncated_totals(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """limit, tokens, cut: what is left under each context limit, and the documents it cuts."""
    asked = histogram.select(
        "length", "documents", F.explode(F.array(*[F.lit(int(x)) for x in limits])).alias("limit")
    )
    return asked.groupBy("limit").agg(
        F.sum(F.least("length", "limit") * F.col("documents")).alias("tokens"),
        F.sum(F.when(F.col("length") > F.col("limit"), F.col("documents")).otherwise(0)).alias("cut"),
    )

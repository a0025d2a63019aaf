"""Exact deduplication by content sort, in DataFrame operations only.

Rows are dealt out by range over (leading text, hash of the text) with Spark's sampled
splitters, sorted within each range, and a window walks the sorted neighbours and compares
their whole normalised texts. The splitters hold at most ``LEAD`` characters and a hash, so
what Spark samples stays small however long the texts are.

A text that makes up more than ``hot_share`` of the rows is hot; there can be no more than
``1 / hot_share`` of those by hash. Their rows get a salt by their place in the input, whatever
their identifiers, so that they are dealt over many ranges, and a second pass merges the one
survivor of each salt.

Defined results:

* Null text counts as the empty text, so null and empty texts are copies of each other.
* A null identifier is larger than none and smaller than none: it stays only when all
  identifiers of the group are null (``keep_id`` is then null).
* Repeated rows (same text, same identifier) are copies; exactly one row of a group has
  ``kept`` true.
* An empty table gives an empty result. Extra columns, whatever their names, are ignored by
  ``content_sort`` and returned untouched by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthtide.llm.frames import Sealed, ascii_lower, seal, settle

LEAD = 32
HOT_SHARE = 0.001


def content_sort(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` is "smallest" or "largest": which identifier of equal texts stays.
    """
    sealed = seal(docs.select(F.col(id_col), F.col(text_col)))
    judged = _judge(sealed, "_c0", "_c1", keep, hot_share, carry=[])
    return judged.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256"
    )


def drop_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """``docs`` with one row of each group of equal texts."""
    sealed = seal(docs)
    judged = _judge(
        sealed,
        sealed.column(id_col),
        sealed.column(text_col),
        keep,
        hot_share,
        carry=sealed.frame.columns,
    )
    return sealed.restore(judged.where("kept"))


def _judge(
    sealed: Sealed, id_name: str, text_name: str, keep: str, hot_share: float, carry: list[str]
) -> DataFrame:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    if not 0 < hot_share <= 1:
        raise ValueError("hot_share is above 0 and at most 1")
    rows = sealed.frame.withColumns(
        {
            "id": F.col(id_name),
            "raw": F.col(text_name),
            "text": F.coalesce(F.col(text_name).cast("string"), F.lit("")),
            "row": F.monotonically_increasing_id(),
        }
    )
    # Texts that are equal after lower-casing A-Z are equal after lower(), so this hash,
    # which is cheaper, never parts them. Equality itself is decided on the whole text.
    rows = rows.withColumn("hash", F.xxhash64(F.lower("text")))
    hot = _hot_hashes(rows, hot_share)
    rows = rows.join(F.broadcast(hot), "hash", "left").withColumns(
        {
            "lead": F.substring(F.lower(F.substring("text", 1, LEAD)), 1, LEAD),
            "hot": F.col("salts").isNotNull(),
            "salt": F.coalesce(F.pmod(F.xxhash64("row"), "salts"), F.lit(0)),
        }
    )
    place = ["lead", "hash", "salt"]
    payload = [c for c in carry if c not in (id_name, text_name)]
    rows = rows.select(*payload, "id", "raw", "hot", *place)
    text = F.coalesce(F.col("raw").cast("string"), F.lit(""))
    sorted_rows = rows.repartitionByRange(*place).withColumn("norm", ascii_lower(text))
    first = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    group = Window.partitionBy(*place, "norm")
    neighbours = group.orderBy(first)
    kept_columns = [*payload, "id", *(["raw"] if carry else [])]
    walked = sorted_rows.select(
        *kept_columns,
        "hot",
        "salt",
        F.sha2("norm", 256).alias("text_sha256"),
        F.row_number().over(neighbours).alias("place"),
        F.first("id").over(neighbours).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
        F.col("norm"),
    ).withColumn("norm", F.when(F.col("hot") & (F.col("place") == 1), F.col("norm")))
    walked = settle(walked)

    cold = walked.where("not hot").select(
        *kept_columns, "keep_id", "group_size", (F.col("place") == 1).alias("kept"), "text_sha256"
    )
    best = F.max("keep_id") if keep == "largest" else F.min("keep_id")
    firsts = walked.where("hot and place = 1")
    merged = firsts.groupBy("norm", "text_sha256").agg(
        best.alias("best"), F.sum("group_size").alias("size")
    )
    # of the salts whose survivor has the best identifier, the first has the group's
    holds = F.min(F.when(F.col("keep_id").eqNullSafe(F.col("best")), F.col("salt")))
    merged = settle(
        firsts.join(merged, ["norm", "text_sha256"])
        .groupBy("text_sha256")
        .agg(holds.alias("best_salt"), F.first("best").alias("best"), F.first("size").alias("size"))
    )
    salted = (
        walked.where("hot")
        .join(merged, "text_sha256")
        .select(
            *kept_columns,
            F.col("best").alias("keep_id"),
            F.col("size").alias("group_size"),
            ((F.col("place") == 1) & (F.col("salt") == F.col("best_salt"))).alias("kept"),
            "text_sha256",
        )
    )
    judged = cold.unionByName(salted)
    if not carry:
        return judged
    return judged.withColumns({id_name: F.col("id"), text_name: F.col("raw")})


def _hot_hashes(rows: DataFrame, hot_share: float) -> DataFrame:
    """hash, salts of the texts that hold more than ``hot_share`` of the rows.

    At most ``1 / hot_share`` hashes can. Each salt gets about ``hot_share`` of the rows.
    """
    most = max(1.0, hot_share * rows.count())
    return (
        rows.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > most)
        .select("hash", F.ceil(F.col("n") / most).alias("salts"))
    )

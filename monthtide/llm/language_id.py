"""Language identification in two steps: the family first, then the language within it.

Features are letter n-grams of one to four bytes of the lower-cased whole text, hashed into
``BINS`` bins and divided by their number. Linear support vector machines weigh them: one
against the rest for each family, one for each pair of languages of a family. A text's score
under a machine is the mean weight of its n-grams, so tasks never build a feature vector.

The machines learn from a sample of at most ``per_language`` different labelled texts of each
label, fewer with so many labels that ``sample`` would be passed, but ``LEAST`` of each; it is
chosen by a hash of the text, so reruns agree. Every row is predicted. Identifier, label and source never enter a prediction.

Defined results:

* Null texts and texts without a letter are ``und`` with score 0; so is every text if no
  labelled row could be learned from.
* A row whose identifier is null counts as held out.
* Labels without a known family are a family of their own. If there is one label only, each
  text with a letter gets it, with score 1.
* Ties between languages go to the one with the greater sum of margins, then to the first by
  code point. Repeated rows get the same prediction. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthtide.llm.frames import seal
from monthtide.llm.words import slices

UND = "und"
BINS = 1 << 12
ORDERS = (1, 2, 3, 4)
PER_LANGUAGE = 500
#: Rows of the sample, 16 KB each on the driver, and the least of each label.
SAMPLE, LEAST = 16_000, 20
#: Bytes of text and rows of features that a task works on at a time.
SLICE_BYTES, SLICE_ROWS = 1 << 19, 256
FOLDS = 5

FAMILIES = {
    "germanic": "de en nl sv da no nb nn is af".split(),
    "romance": "es fr it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz".split(),
}


@dataclass(frozen=True)
class Machine:
    """Two groups of labels (or a family and the rest) and the plane between them."""

    first: str
    second: str | None
    bias: float


@dataclass(frozen=True)
class Model:
    families: dict[str, list[str]]
    machines: list[Machine]
    weights: np.ndarray  # one row for each bin, one column for each machine

    @property
    def languages(self) -> list[str]:
        return sorted(x for members in self.families.values() for x in members)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: the CRC of the identifier's text is divisible by 5."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == 0


def fit(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "lang",
    families: dict[str, Sequence[str]] = FAMILIES,
    per_language: int = PER_LANGUAGE,
    sample: int = SAMPLE,
) -> Model:
    """Learn from rows with text and label; the sample's size is bounded by the parameters."""
    rows = labelled.select(
        F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    key = F.xxhash64("text", "lang")
    rows = rows.withColumn("key", key)
    # copies of a text count once
    counted = rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("count")).collect()
    if not counted:
        return Model({}, [], np.zeros((BINS, 0), np.float32))
    each = min(per_language, max(LEAST, sample // len(counted)))
    # By hash, about half as many again as needed; then exactly the first of those.
    grain = 1 << 30
    most = {r["lang"]: int(min(grain, 1 + 1.5 * grain * each / max(1, r["count"]))) for r in counted}
    limit = F.create_map(*[F.lit(x) for pair in most.items() for x in pair])
    drawn = (
        rows.where(F.pmod("key", F.lit(grain)) < limit[F.col("lang")])
        .groupBy("lang", "key")
        .agg(F.min("text").alias("text"))
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("key")))
        .where(F.col("place") <= each)
        .select("text", "lang")
    )
    sample = drawn.mapInArrow(_features, "lang string, features binary").toArrow()
    labels = np.array(sample.column("lang").to_pylist())
    # The sample is held once: scaled, with a last column for the bias.
    x = np.ones((len(labels), BINS + 1), np.float32)
    for row, v in zip(x, sample.column("features"), strict=True):
        row[:-1] = np.frombuffer(v.as_buffer(), np.float32)
    del sample
    order = np.lexsort((x[:, :-1] @ np.arange(1, BINS + 1, dtype=np.float32), labels))
    x[:, :-1] *= SCALE
    return _learn(x, order, labels, families)


def _learn(
    x: np.ndarray, order: np.ndarray, labels: np.ndarray, families: dict[str, Sequence[str]]
) -> Model:
    family_of = {lang: name for name, members in families.items() for lang in members}
    groups: dict[str, list[str]] = {}
    for lang in sorted(set(labels.tolist())):
        groups.setdefault(family_of.get(lang, f"={lang}"), []).append(lang)
    machines, planes = [], []

    def add(first: str, second: str | None, chosen: np.ndarray, positive: Sequence[str]) -> None:
        y = np.where(np.isin(labels[chosen], positive), 1.0, -1.0).astype(np.float32)
        plane = _support_vectors(x, chosen, y)
        machines.append(Machine(first, second, float(plane[-1])))
        planes.append(plane[:-1])

    if len(groups) > 1:
        for name, members in groups.items():
            add(name, None, order, members)
    for members in groups.values():
        for a, b in combinations(members, 2):
            add(a, b, order[np.isin(labels[order], [a, b])], [a])
    weights = np.stack(planes, 1) if planes else np.zeros((BINS, 0))
    return Model(groups, machines, np.ascontiguousarray(weights, np.float32))


def _support_vectors(
    x: np.ndarray, chosen: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30
):
    """Plane with the largest soft margin between the chosen rows, by coordinate descent on the
    dual; bias last. Rows are read where they are, so the sample is never copied."""
    size = np.array([x[k] @ x[k] for k in chosen])
    alpha, plane = np.zeros(len(chosen)), np.zeros(x.shape[1])
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for i in rng.permutation(len(chosen)):
            row = x[chosen[i]]
            step = (y[i] * (row @ plane) - 1) / size[i]
            new = min(max(alpha[i] - step, 0.0), cost)
            if new != alpha[i]:
                plane += (new - alpha[i]) * y[i] * row
                alpha[i] = new
    return np.concatenate([plane[:-1] * SCALE, plane[-1:]])


#: Shares of n-grams are small numbers; the machines learn them at this scale.
SCALE = 16.0


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` under internal column names, followed by lang_pred and score.

    Only the texts go to Python; rows wait where they are.
    """
    sealed = seal(docs)
    # Plain values: tasks unpickle a broadcast without this package.
    plain = (model.families, [(m.first, m.second, m.bias) for m in model.machines], model.weights)
    shared = docs.sparkSession.sparkContext.broadcast(plain)

    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        families, machines, weights = shared.value
        held = Model(families, [Machine(*m) for m in machines], weights)
        for batch in batches:
            column = pa.RecordBatch.from_arrays([batch], ["text"])
            found = [_predict(held, x.column("text")) for x in slices([column], "text", SLICE_BYTES)]
            langs = [lang for lang, _ in found] or [pa.array([], pa.string())]
            scores = [score for _, score in found] or [pa.array([], pa.float64())]
            yield pa.StructArray.from_arrays(
                [pa.concat_arrays(langs), pa.concat_arrays(scores)], ["lang_pred", "score"]
            )

    judge = F.arrow_udf(judged, "lang_pred string, score double")
    text = F.col(sealed.column(text_col)).cast("string")
    rows = sealed.frame.withColumn("_judged", judge(text))
    return rows.select(
        *sealed.frame.columns,
        F.col("_judged.lang_pred").alias("lang_pred"),
        F.col("_judged.score").alias("score"),
    )


def predicted_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", **fitting
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, learned from those not held out."""
    model = fit(docs.where(~held_out(F.col(id_col))), text_col, label_col, **fitting)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return identify(rows, model).select(
        F.col("_c0").alias("doc_id"), held_out(F.col("_c0")).alias("held_out"), "lang_pred", "score"
    )


def keep_identified(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    languages: Sequence[str] | None = None,
    **fitting,
) -> DataFrame:
    """``docs`` without those in no language that was learned (or none of ``languages``)."""
    model = fit(docs.where(~held_out(F.col(id_col))), text_col, label_col, **fitting)
    wanted = model.languages if languages is None else list(languages)
    if not model.languages:  # nothing to judge by
        return docs
    judged = identify(docs, model, text_col)
    return seal(docs).restore(judged.where(F.col("lang_pred").isin(wanted)))


# --- in the tasks -------------------------------------------------------------------


def _grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the bins of all n-grams and the text that each belongs to."""
    lower = pc.utf8_lower(pc.fill_null(texts, ""))
    if isinstance(lower, pa.ChunkedArray):
        lower = lower.combine_chunks()
    ends = np.frombuffer(lower.buffers()[1], np.int32)[lower.offset : lower.offset + len(lower) + 1]
    data = np.frombuffer(lower.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    owner = np.repeat(np.arange(len(lower)), np.diff(ends))
    letter = (data >= 128) | ((data >= 97) & (data <= 122))
    start = np.zeros(len(data), bool)
    start[(ends[:-1] - ends[0])[np.diff(ends) > 0]] = True
    # other characters end a word: one blank for a run of them
    before = np.concatenate([[True], letter[:-1]])
    keep = letter | before | start
    owner, data = owner[keep], np.where(letter, data, 32)[keep].astype(np.uint64)
    value = np.zeros(len(data), np.uint64)
    for k, order in enumerate(range(1, max(ORDERS) + 1)):
        if len(data) < order:
            return
        n = len(data) - k
        value = value[:n] | (data[k:] << np.uint64(8 * k))
        if order not in ORDERS:
            continue
        whole = owner[:n] == owner[k:]
        mixed = (value[whole] + np.uint64(order << 40)) * np.uint64(0x9E3779B97F4A7C15)
        yield (mixed >> np.uint64(52)).astype(np.int64), owner[:n][whole]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in (
        x.slice(k, SLICE_ROWS)
        for x in slices(batches, "text", SLICE_BYTES)
        for k in range(0, x.num_rows, SLICE_ROWS)
    ):
        counts = np.zeros(part.num_rows * BINS, np.float32)
        for bins, owner in _grams(part.column("text")):
            counts += np.bincount(owner * BINS + bins, minlength=len(counts)).astype(np.float32)
        counts = counts.reshape(part.num_rows, BINS)
        counts /= np.maximum(counts.sum(1, keepdims=True), 1)
        rows = pa.array([x.tobytes() for x in counts], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column("lang"), rows], ["lang", "features"])


def _margins(model: Model, texts: pa.Array) -> np.ndarray:
    sums = np.zeros((len(texts), len(model.machines)))
    number = np.zeros(len(texts))
    for bins, owner in _grams(texts):
        number += np.bincount(owner, minlength=len(texts))
        for k in range(len(model.machines)):
            sums[:, k] += np.bincount(owner, model.weights[bins, k], minlength=len(texts))
    return sums / np.maximum(number, 1)[:, None] + np.array([m.bias for m in model.machines])


def _predict(model: Model, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    has_letter = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False)
    has_letter = has_letter.to_numpy(zero_copy_only=False)
    if not model.families:
        return pa.array([UND] * len(texts)), pa.array(np.zeros(len(texts)))
    margins = _margins(model, texts)
    sure: Callable[[np.ndarray], np.ndarray] = lambda m: 1 / (1 + np.exp(-2 * np.clip(m, -30, 30)))
    names = list(model.families)
    lang = np.full(len(texts), UND, object)
    score = np.zeros(len(texts))
    if len(names) > 1:
        best = margins[:, : len(names)].argmax(1)
        family_score = sure(margins[np.arange(len(texts)), best])
    else:
        best, family_score = np.zeros(len(texts), int), np.ones(len(texts))
    pairs = {(m.first, m.second): k for k, m in enumerate(model.machines) if m.second is not None}
    for f, members in enumerate(model.families.values()):
        rows = np.flatnonzero(has_letter & (best == f))
        votes = np.zeros((len(rows), len(members)))
        total = np.zeros((len(rows), len(members)))
        least = np.full((len(rows), len(members)), np.inf)
        for (a, b), k in pairs.items():
            if a in members:
                i, j, m = members.index(a), members.index(b), margins[rows, k]
                votes[:, i] += m >= 0
                votes[:, j] += m < 0
                for at, own in ((i, m), (j, -m)):
                    total[:, at] += own
                    least[:, at] = np.minimum(least[:, at], own)
        won = np.array(
            [max(range(len(members)), key=lambda c: (v[c], t[c])) for v, t in zip(votes, total)], int
        )
        lang[rows] = np.array(members, object)[won]
        within = sure(least[np.arange(len(rows)), won]) if len(members) > 1 else 1.0
        score[rows] = family_score[rows] * within
    return pa.array(lang.tolist(), pa.string()), pa.array(score)

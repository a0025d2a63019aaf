"""Benchmark decontamination by template canonicalisation.

A text becomes its template: numbers, names and units turn into typed placeholders, other
words are lower-cased and lose the punctuation around them. Windows of ``WINDOW`` template
tokens of all documents are hash-joined with those of the benchmark. Where a window matches,
its placeholders are slots with a value on either side, and a document holds an item if the
windows that agree on the slots (each value of the item stands for one value of the document)
cover enough of the item. So a question is caught whole, in part, and with other numbers,
names or units in it.

Tokens: a number is digits with their separators, with up to three letters or a sign after it,
or a number word. A unit is a known unit right after a number. A name is a word with a capital
first and small letters after it; in the plain form, not one that begins the text or follows
the end of a sentence.
Windows with fewer than ``MIN_LITERALS`` ordinary words match by their values, not their
template; otherwise any table of numbers would match any other.

Windows have a second form where they differ in it: capitalised words that begin a text or
sentence are names too, and a run of names or of number words within a sentence is one
placeholder. With ``any_case`` they also have a form in which names are ordinary words, so that
lower-cased and upper-cased copies of an item match. All forms share one space of hashes, so
any form of a document matches any form of an item, and matched positions are united.

Only windows that pass a bit filter of fixed size leave the tasks; the join itself is Spark's,
which broadcasts the benchmark's windows only if their measured size allows. The filter never
loses a window.

Defined results:

* Null and empty texts hold nothing, on either side; so do items of fewer than ``MIN_ITEM``
  tokens, which can't be told from ordinary language. Items of fewer than ``WINDOW`` tokens
  are one window. Rows of the benchmark that repeat an item each count by ``item_id``; a null
  ``item_id`` is an item like others.
* A document is its identifier and its text: rows with equal identifiers and different texts
  are judged apart, rows that repeat both once, and rows without identifier by their text.
* Of several occurrences of an item in a document, the one that covers most is reported, and
  of equal ones the first. Empty tables give an empty result (or, when dropping, all
  documents). Other columns are ignored or returned untouched.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthtide.llm.frames import batches_of, seal, settle
from monthtide.llm.words import mix, slices, split, window_hashes

WINDOW = 8
MIN_LITERALS = 4
MIN_ITEM = 6
MIN_COVERAGE = 0.5
FILTER_BITS = 1 << 23
#: Rows of texts that a task hands to Python at a time.
TEXT_ROWS = 2_000

LITERAL, NUMBER, NAME, UNIT, NOTHING = range(5)
PLACEHOLDERS = np.array([0, 0x6E756D, 0x6E616D65, 0x756E6974], np.uint64)

NUMBER_WORDS = set(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty "
    "ninety hundred thousand million billion".split()
)
UNITS = set(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles g kg mg lb lbs oz ounce "
    "ounces gram grams kilogram kilograms ton tons ml l liter liters litre litres gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years cent cents dollar dollars euro euros pound pounds usd eur gbp percent degree "
    "degrees meter meters metre metres kilometer kilometers kilometre kilometres mph kmh".split()
)
CORE = re.compile(r"[^\W_](?:.*[^\W_])?", re.DOTALL)
NUMERIC = re.compile(r"\d[\d.,:/-]*[^\W\d_]{0,3}")
SENTENCE_END = re.compile(r"[.!?:;…]")


def classify(word: str) -> tuple[int, int, bool, str]:
    """Kind, hash of the plain word, does it end a sentence, the plain word."""
    found = CORE.search(word)
    if not found:
        return NOTHING, 0, bool(SENTENCE_END.search(word)), ""
    core = found.group()
    plain = core.lower()
    if NUMERIC.fullmatch(core) or plain in NUMBER_WORDS:
        kind = NUMBER
    elif plain in UNITS:
        kind = UNIT
    elif len(core) > 1 and core[0].isupper() and core[1:] == plain[1:]:
        kind = NAME
    else:
        kind = LITERAL
    return kind, xxhash.xxh3_64_intdigest(plain), bool(SENTENCE_END.search(word[found.end() :])), plain


@dataclass(frozen=True)
class Form:
    """One reading of the tokens of a few texts; each of its tokens stands for ``start:stop``."""

    plain: bool
    kind: np.ndarray
    value: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    owner: np.ndarray
    changed: np.ndarray

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each window of ``size`` tokens within one text starts, its hash, is it by value.

        Of a form but the plain one, only the windows that differ from the plain form.
        """
        hashes = window_hashes(np.where(self.kind == LITERAL, self.value, PLACEHOLDERS[self.kind]), size)
        n = len(hashes)
        words = np.concatenate([[0], np.cumsum(self.kind == LITERAL)])
        few = words[size:][:n] - words[:n] < min(MIN_LITERALS, size)
        if few.any():
            hashes = np.where(few, mix(window_hashes(self.value, size) + np.uint64(1)), hashes)
        use = self.owner[:n] == self.owner[size - 1 :][:n]
        if not self.plain:
            changes = np.concatenate([[0], np.cumsum(self.changed)])
            use = use & (changes[size:][:n] > changes[:n])
        whole = np.flatnonzero(use)
        return whole, hashes[whole].view(np.int64), few[whole]


class Templates:
    """The template tokens of a few texts; a token's text is its first word of that code."""

    def __init__(self, texts: pa.Array, any_case: bool = False):
        words, ends = split(texts, lower=False)
        coded = words.dictionary_encode()
        classes = [classify(w) for w in coded.dictionary.to_pylist()]
        code = coded.indices.to_numpy(zero_copy_only=False)
        self.plain = [c[3] for c in classes]
        kind = np.array([c[0] for c in classes], np.uint8)[code]
        value = np.array([c[1] for c in classes], np.uint64)[code]
        closes = np.array([c[2] for c in classes], bool)[code]
        opens = np.concatenate([[True], closes[:-1]])[: len(code)]
        firsts = np.concatenate([[0], ends[:-1]])
        opens[firsts[firsts < np.append(ends, 0)[: len(firsts)]]] = True
        real = kind != NOTHING
        self.ends = np.concatenate([[0], np.cumsum(real)])[ends]
        self.owner = np.repeat(np.arange(len(ends)), np.diff(self.ends, prepend=0))
        self.code, kind, self.value = code[real], kind[real], value[real]
        # a mark that stands alone ends a sentence too, so what opens is told before marks go
        opens = opens[real]
        after = np.concatenate([[False], (kind == NUMBER)[:-1]])[: len(kind)]
        first = np.concatenate([[True], np.diff(self.owner) > 0])[: len(kind)]
        kind[(kind == UNIT) & ~(after & ~first)] = LITERAL
        all_names, self.kind = kind, np.where((kind == NAME) & opens, LITERAL, kind).astype(np.uint8)
        each = np.arange(len(kind))
        none = np.zeros(len(kind), bool)
        self.forms = [Form(True, self.kind, self.value, each, each + 1, self.owner, none)]

        spelt = np.array([x in NUMBER_WORDS for x in self.plain], bool)[self.code]
        sort = np.where(spelt, 2, (all_names == NAME).astype(int))
        joins = none.copy()
        joins[1:] = (sort[1:] > 0) & (sort[1:] == sort[:-1]) & ~opens[1:] & ~first[1:]
        start = np.flatnonzero(~joins)
        stop = np.append(start[1:], len(kind))[: len(start)]
        changed = (stop - start > 1) | (all_names != self.kind)[start]
        if changed.any():
            nth = (each - start[np.cumsum(~joins) - 1]).astype(np.uint64)
            run = np.add.reduceat(np.where(nth > 0, mix(self.value + nth), self.value), start)
            self.forms.append(
                Form(False, all_names[start], run, start, stop, self.owner[start], changed)
            )
        if any_case and (named := self.kind == NAME).any():
            words_only = np.where(named, LITERAL, self.kind).astype(np.uint8)
            self.forms.append(Form(False, words_only, self.value, each, each + 1, self.owner, named))

    def slots(self, form: Form, start: int, size: int) -> list[str]:
        at = np.flatnonzero(form.kind[start : start + size] != LITERAL) + start
        return [
            " ".join(self.plain[c] for c in self.code[form.start[i] : form.stop[i]]) for i in at
        ]


def benchmark_windows(
    benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", any_case: bool = False
) -> DataFrame:
    """item_id, hash, size, pos, span, tokens, plain, by_value, slots: all template windows of all items.

    ``span`` is the number of the item's tokens that a window of ``size`` stands for.
    """
    items = benchmark.select(
        F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = Templates(part.column("text"), any_case)
            lengths = np.diff(found.ends, prepend=0)
            for form, size in product(found.forms, range(MIN_ITEM, WINDOW + 1)):
                starts, hashes, by_value = form.windows(size)
                length = np.bincount(form.owner, minlength=len(lengths))[form.owner[starts]]
                use = length >= WINDOW if size == WINDOW else length == size
                starts, hashes, by_value = starts[use], hashes[use], by_value[use]
                owner = form.owner[starts]
                first = np.concatenate([[0], found.ends[:-1]])[owner]
                start, stop = form.start[starts], form.stop[starts + size - 1]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("item_id").take(pa.array(owner)),
                        pa.array(hashes),
                        pa.array(np.full(len(starts), size, np.int32)),
                        pa.array((start - first).astype(np.int32)),
                        pa.array((stop - start).astype(np.int32)),
                        pa.array(lengths[owner].astype(np.int32)),
                        pa.array(np.full(len(starts), form.plain)),
                        pa.array(by_value),
                        pa.array([found.slots(form, s, size) for s in starts], pa.list_(pa.string())),
                    ],
                    ["item_id", "hash", "size", "pos", "span", "tokens", "plain", "by_value", "slots"],
                )

    kind = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(
        run,
        f"item_id {kind}, hash long, size int, pos int, span int, tokens int, plain boolean, "
        "by_value boolean, slots array<string>",
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_coverage: float = MIN_COVERAGE,
    any_case: bool = False,
) -> DataFrame:
    """A row for each document and item it holds.

    doc_id, item_id, coverage (share of the item's tokens), covered, item_tokens, start (the
    token of the document where it begins), reparameterised, bindings (the item's slot values
    and the document's), and text_key, which with doc_id tells which text it is.
    """
    of_items = settle(benchmark_windows(benchmark, item_col, item_text_col, any_case))
    bit = F.pmod("hash", F.lit(FILTER_BITS)).cast("int")
    marks = of_items.select(bit.alias("bit"), "size").distinct().toArrow()
    flags = np.zeros(FILTER_BITS, bool)
    flags[marks.column("bit").to_numpy()] = True
    sizes = sorted(set(marks.column("size").to_pylist()))
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(flags))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(shared.value).astype(bool)
        for part in slices(batches, "text"):
            found = Templates(part.column("text"), any_case)
            for form, size in product(found.forms, sizes):
                starts, hashes, _ = form.windows(size)
                hit = held[hashes % FILTER_BITS]
                starts, hashes = starts[hit], hashes[hit]
                owner = form.owner[starts]
                first = np.concatenate([[0], found.ends[:-1]])[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c).take(pa.array(owner)) for c in ("doc_id", "text_key")],
                        pa.array((form.start[starts] - first).astype(np.int32)),
                        pa.array(np.full(len(starts), size, np.int32)),
                        pa.array(hashes),
                        pa.array(np.full(len(starts), form.plain)),
                        pa.array([found.slots(form, s, size) for s in starts], pa.list_(pa.string())),
                    ],
                    ["doc_id", "text_key", "doc_pos", "size", "hash", "doc_plain", "doc_slots"],
                )

    texts = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    with batches_of(docs.sparkSession, TEXT_ROWS):
        windows = settle(
            texts.mapInArrow(
                run,
                f"doc_id {kind}, text_key long, doc_pos int, size int, hash long, "
                "doc_plain boolean, doc_slots array<string>",
            )
        )
    shared.destroy()
    matches = windows.join(of_items, ["hash", "size"]).select(
        "doc_id", "text_key", "item_id", "tokens",
        F.struct(
            "doc_pos", "pos", "size", "span", (F.col("plain") & F.col("doc_plain")).alias("plain"),
            # equal values are equal slots, whatever they are taken for on either side
            F.when(F.col("by_value"), F.col("slots")).otherwise(F.col("doc_slots")).alias("doc_slots"),
            "slots",
        ).alias("match"),
    )
    gathered = matches.groupBy("doc_id", "text_key", "item_id", "tokens").agg(
        F.collect_set("match").alias("matches")
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [
                best_occurrence(m, n)
                for m, n in zip(batch.column("matches").to_pylist(), batch.column("tokens").to_pylist())
            ]
            rows = pa.RecordBatch.from_pylist(
                judged,
                pa.schema([
                    ("coverage", pa.float64()), ("covered", pa.int32()), ("start", pa.int32()),
                    ("reparameterised", pa.bool_()), ("bindings", pa.map_(pa.string(), pa.string())),
                ]),
            )
            head = batch.select(["doc_id", "text_key", "item_id", "tokens"])
            yield pa.RecordBatch.from_arrays(
                [*head.columns, *rows.columns], [*head.schema.names, *rows.schema.names]
            )

    item_kind = of_items.schema["item_id"].dataType.simpleString()
    judged = gathered.mapInArrow(
        judge,
        f"doc_id {kind}, text_key long, item_id {item_kind}, tokens int, coverage double, covered int, "
        "start int, reparameterised boolean, bindings map<string,string>",
    )
    return judged.where(F.col("coverage") >= min_coverage).select(
        "doc_id", "item_id", "coverage", "covered", F.col("tokens").alias("item_tokens"), "start",
        "reparameterised", "bindings", "text_key",
    )


def best_occurrence(matches: list[dict], tokens: int) -> dict:
    """What the best occurrence covers of an item of ``tokens`` tokens.

    Windows belong to one occurrence while the shift between document and item changes by no
    more than half an item from one to the next.
    """
    matches = sorted(matches, key=lambda m: (m["doc_pos"] - m["pos"], m["pos"]))
    groups: list[list[dict]] = []
    for m in matches:
        shift = m["doc_pos"] - m["pos"]
        if not groups or shift - last > tokens / 2:
            groups.append([])
        groups[-1].append(m)
        last = shift
    best = max((_covered(g, tokens) for g in groups), key=lambda b: (b["covered"], -b["start"]))
    return best


def _paired(match: dict) -> list[tuple[str, str]]:
    """The slots of a match: the item's value and the document's. Runs are paired word by word."""
    out = []
    for mine, theirs in zip(match["slots"], match["doc_slots"]):
        a, b = mine.split(), theirs.split()
        if len(a) == len(b):
            out += zip(a, b)
            continue
        while len(a) > 1 and len(b) > 1 and a[0] == b[0]:
            out.append((a.pop(0), b.pop(0)))
        # the word before a name may open the sentence; the name is what has the value
        out.append((a[-1] if len(b) == 1 else " ".join(a), " ".join(b)))
    return out


def _covered(matches: list[dict], tokens: int) -> dict:
    """Matches of the plain form count first, then those others that cover more of the item."""
    chosen: dict[str, str] = {}
    agreed, used, covered = [], {}, set()
    for plain in (True, False):
        own = [(m, _paired(m)) for m in matches if m.get("plain", True) == plain]
        votes: dict[str, Counter] = defaultdict(Counter)
        for _, pairs in own:
            for mine, theirs in set(pairs):
                votes[mine][theirs] += 1
        best = {k: min(v, key=lambda x: (-v[x], x != k, x)) for k, v in votes.items()}
        chosen = best | chosen
        # runs of one length on both sides first
        own.sort(key=lambda x: any(" " in a or " " in b for a, b in x[1]))
        for m, pairs in own:
            places = set(range(m["pos"], m["pos"] + m.get("span", m["size"])))
            if all(chosen[a] == b for a, b in pairs) and (plain or not places <= covered):
                agreed.append(m)
                covered |= places
                used |= {a: b for a, b in pairs if plain or a != b}
    return {
        "covered": len(covered),
        "coverage": len(covered) / tokens,
        "start": min((m["doc_pos"] for m in agreed), default=0),
        "reparameterised": any(a != b for a, b in used.items()),
        "bindings": list(used.items()),
    }


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """``docs`` without the texts that hold an item of the benchmark."""
    sealed = seal(docs)
    found = contaminated(docs, benchmark, id_col, text_col, **options)
    gone = settle(found.select("doc_id", "text_key").distinct())
    frame = sealed.frame.withColumn(
        "_key", F.xxhash64(F.col(sealed.column(text_col)).cast("string"))
    )
    same = (frame["_key"] == gone["text_key"]) & frame[sealed.column(id_col)].eqNullSafe(gone["doc_id"])
    return sealed.restore(frame.join(gone, same, "left_anti"))

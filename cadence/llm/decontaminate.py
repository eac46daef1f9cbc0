"""Benchmark decontamination by templates.

Numbers, units and names become typed placeholders; hashes of windows of the
resulting template tokens are joined between documents and benchmark items.
Windows of one document and item that lie on one diagonal (equal distance of
their positions) form a match; it holds if it covers enough of the item and its
slots are filled consistently: one value of the item always stands for one
value of the document and the other way round.  So a question whose numbers or
names were replaced is found, and a sentence that shares only its frame with
arbitrary fillings is not.

Every window is hashed twice: once with all placeholders, once with names kept
as words (a passage set in another sentence may lose or gain capitals).  These
windows need words for half of their tokens.  Items with windows that fail this,
and items of WINDOW words or less, are also looked for as they are: windows over
all their words in lower case, numbers, signs and operators kept, an item of
less than WINDOW words being one window.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import prepared, staged, text_or_empty

WINDOW = 8
#: An item of at least this many tokens can be matched as a template.
LEAST = 5
#: A match covers half of the item's tokens, at least WINDOW, at most this many.
ENOUGH = 13
#: Share of slots that may disagree with the match's own substitution.
SLACK = 0.2
#: Bits of the sieve of window hashes that tasks look windows up in before the
#: join, whatever the number of items (16 MB).
SIEVE_BITS = 27

#: Units after a number (fixed values).
UNITS = frozenset(
    "% mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l s sec secs second seconds min mins minute minutes h hr hrs hour "
    "hours day days week weeks month months year years meter meters metre metres kilometer kilometers kilometre "
    "kilometres mile miles foot feet inch inches gram grams kilogram kilograms kilo kilos pound pounds ounce ounces "
    "liter liters litre litres dollar dollars cent cents euro euros usd eur mph kph km/h m/s degrees percent points".split()
)
#: Number words (fixed values).
NUMBER_WORDS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()
)
_PUNCTUATION = ".,;:!?\"'()[]{}«»“”„’‘…—–-"
_EDGE = re.compile(r"^[^\w%$€£°]+|[^\w%°]+$")
_NUMBER = re.compile(r"[+-]?[$€£]?\d+(?:[.,:/]\d+)*")
_QUANTITY = re.compile(r"[+-]?\d+(?:[.,]\d+)*([a-z%°/]+)")
_WORD, _NUM, _UNIT, _NAME, _AMOUNT = range(5)  # kinds; an amount is a number with its unit attached
_MASK = (1 << 64) - 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_RAW = np.uint64(0xD1B54A32D192ED03)  # keeps hashes of raw windows apart from the others
#: Edges of a raw word; a number keeps its sign and point.
_RAW_EDGE = re.compile(r"^(?:(?![+-]?[$€£]?\.?\d)[^\w%$€£°])+|[^\w%°]+$")
_SENTENCE = ".,;:!?\"'()[]{}«»“”„’‘…"


def _mark(kind: int) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(f"\0slot{kind}"))


_MARKS = np.array([0, *[int(_mark(k)) for k in (_NUM, _UNIT, _NAME, _AMOUNT)]], dtype=np.uint64)


def _raw_hash(raw: str) -> int:
    """Hash of a word as it is (of operators too); 0 if it is punctuation only."""
    low = raw.lower()
    form = _RAW_EDGE.sub("", low) or low.strip(_SENTENCE)
    return xxhash.xxh64_intdigest(form) or 1 if form else 0


def _props(raw: str) -> tuple[int, int, int, int]:
    """(word hash, kind without context, flags, raw hash): flag 1 a capitalised
    word, 2 it may be a unit, 4 it ends a sentence."""
    ends = 4 if raw.rstrip("\"')]»”’")[-1:] in (".", "!", "?", ":", "…") else 0
    core = raw.strip(_PUNCTUATION)
    if not core.isalpha():
        core = _EDGE.sub("", raw)
    low = core.lower()
    if not low:
        return 0, -1, ends, _raw_hash(raw)
    kind, flags = _WORD, ends
    if low in NUMBER_WORDS:
        kind = _NUM
    elif low in UNITS:
        flags |= 2
    elif not low.isalpha():
        q = _QUANTITY.fullmatch(low)
        if _NUMBER.fullmatch(low):
            kind = _NUM
        elif q and q[1] in UNITS:
            kind = _AMOUNT
    if kind == _WORD and len(core) > 1 and core[0].isupper() and core[1:].islower():
        flags |= 1
    h = xxhash.xxh64_intdigest(low)
    return h, kind, flags, (h or 1) if core.isalpha() else _raw_hash(raw)


class Canon:
    """Templates of texts; properties of words seen are kept, up to a bound."""

    def __init__(self, most: int = 400_000):
        self.known: dict[str, tuple[int, int, int, int]] = {}
        self.most = most

    def _of(self, raw: str) -> tuple[int, int, int, int]:
        got = _props(raw)
        if len(raw) <= 64:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[raw] = got
        return got

    def __call__(self, texts: list[str]):
        """For every text: (cores, literal hashes, template hashes, kinds, raw
        hashes) of its words without those of punctuation only; cores(i, j)
        gives the words i to j in lower case, stripped.  The raw hashes count
        operators as words.  Each different word of the batch is looked at
        once."""
        split = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        flat = split.flatten()
        # the splitter leaves empty strings at the ends of a text
        words = flat.dictionary_encode()
        of, known = self._of, self.known
        p = [known.get(w) or of(w) for w in words.dictionary.to_numpy(zero_copy_only=False).tolist()]
        number = words.indices.to_numpy()
        h_of = np.array([x[0] for x in p], dtype=np.uint64)
        kind_of = np.array([x[1] for x in p], dtype=np.int8)
        flag_of = np.array([x[2] for x in p], dtype=np.int8)
        raw_of = np.array([x[3] for x in p], dtype=np.uint64)
        at = 0
        for n in pc.list_value_length(split).to_pylist():
            own = number[at : at + n]
            kind, flags = kind_of[own], flag_of[own]
            keep = np.flatnonzero(kind >= 0)
            ends = np.r_[0, np.cumsum((flags & 4) > 0)]
            # a sentence starts if one ended since the last word that counts
            starts = np.r_[True, ends[keep[1:]] > ends[keep[:-1]]] if len(keep) else np.zeros(0, bool)
            h, kind, flags = h_of[own[keep]], kind[keep].astype(np.int64), flags[keep]
            after_number = np.r_[False, kind[:-1] == _NUM] if len(kind) else np.zeros(0, bool)
            unit = (kind == _WORD) & after_number & ((flags & 2) > 0)
            name = (kind == _WORD) & ~unit & ~starts & ((flags & 1) > 0)
            kind = np.where(unit, _UNIT, np.where(name, _NAME, kind))
            literal = np.where((kind == _WORD) | (kind == _NAME), h, _MARKS[kind])
            template = np.where(kind == _WORD, h, _MARKS[kind])

            def cores(i: int, j: int, at=at, keep=keep) -> list[str]:
                return [_core(flat[at + k].as_py()) for k in keep[i:j].tolist()]

            raw = raw_of[own]
            yield cores, literal, template, kind, raw[raw != 0]
            at += n


def _core(raw: str) -> str:
    core = raw.strip(_PUNCTUATION)
    return (core if core.isalpha() else _EDGE.sub("", raw)).lower()


def _roll(h: np.ndarray, w: int) -> np.ndarray:
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(w):
            out = out * _BASE + h[j : j + n]
        return out ^ (out >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)


def windows(literal: np.ndarray, template: np.ndarray, kind: np.ndarray, w: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For either hash the (hashes, positions) of its windows; a window needs
    at least half of its tokens to be words on its own level."""
    out = []
    for h, slots in ((template, kind != _WORD), (literal, (kind != _WORD) & (kind != _NAME))):
        rolled = _roll(h, w)
        if len(rolled):
            c = np.r_[0, np.cumsum(slots)]
            ok = np.flatnonzero(2 * (c[w:] - c[:-w]) <= w)
            out.append((rolled[ok], ok))
        else:
            out.append((rolled, np.zeros(0, int)))
    return out


def raw_windows(raw: np.ndarray, w: int) -> np.ndarray:
    return _roll(raw, w) ^ _RAW


def _raw_rows(w: int):
    """Raw windows, w counted negative, of the items whose copies the windows of
    templates may not cover.  Longer items that are words for half of each
    window need none: a copy differs in the kind of its first word at most."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon = Canon()
        for b in batches:
            rows = []
            for item, (_, _, _, kind, raw) in zip(b["item"], canon(b["text"].tolist())):
                c = np.r_[0, np.cumsum(kind != _WORD)]
                if len(raw) and (len(kind) <= w or (2 * (c[w:] - c[:-w]) > w).any()):
                    width = min(w, len(raw))
                    for i, h in enumerate(raw_windows(raw, width).view(np.int64).tolist()):
                        rows.append((h, -width, item, i, len(raw), [], []))
            yield pd.DataFrame(rows, columns=["h", "w", "item", "ipos", "n", "kinds", "cores"])

    return make


def _bench_rows(w: int, short: bool):
    """Windows of the items; an item shorter than w is one window of its length."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon = Canon()
        for b in batches:
            rows = []
            for item, (cores, literal, template, kind, _) in zip(b["item"], canon(b["text"].tolist())):
                n = len(kind)
                if short and not LEAST <= n < w:
                    continue
                width = n if short else w
                for hs, at in windows(literal, template, kind, width):
                    for h, i in zip(hs.view(np.int64).tolist(), at.tolist()):
                        rows.append((h, width, item, i, n, kind.tolist(), cores(0, n)))
            yield pd.DataFrame(rows, columns=["h", "w", "item", "ipos", "n", "kinds", "cores"])

    return make


def _sieve(hashes: DataFrame, bits: int) -> np.ndarray:
    """A fixed number of bits (packed) in which those of all hashes are set;
    its parts are made by a grouped aggregate."""
    place = F.col("h").bitwiseAND(F.lit((1 << bits) - 1)) + 1
    parts = (
        hashes.select(place.alias("x"))
        .groupBy(F.bitmap_bucket_number("x").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("bitmap"))
    )
    out = np.zeros(max(1 << bits >> 3, 4096), np.uint8)
    for r in parts.collect():  # 2 ** bits / 32768 rows of 4096 bytes at most
        at = (r["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(r["bitmap"], np.uint8)
    return out


def _found(widths: list[int], sieve, bits: int, whole: int):
    """Rows (doc_id, mark, h, w, pos, cores) of the documents' windows whose
    hash may be one of the items'.  Raw windows (w negative) have no cores;
    those shorter than ``whole`` are whole items, and one place of each is
    enough."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canon, packed, low = Canon(), sieve.value, np.uint64((1 << bits) - 1)
        for b in batches:
            rows = []
            for doc, mark, (cores, literal, template, kind, raw) in zip(b["doc_id"], b["mark"], canon(b["text"].tolist())):
                for w in widths:
                    if w < 0:
                        hs = raw_windows(raw, -w)
                        levels = [(hs, np.arange(len(hs)))]
                    else:
                        levels = windows(literal, template, kind, w)
                    for hs, at in levels:
                        place = hs & low
                        hit = np.flatnonzero(packed[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                        if not len(hit):
                            continue
                        hs, at = hs[hit], at[hit]
                        if -whole < w < 0:
                            hs, first = np.unique(hs, return_index=True)
                            at = at[first]
                        for h, i in zip(hs.view(np.int64).tolist(), at.tolist()):
                            rows.append((doc, mark, h, w, i, cores(i, i + w) if w > 0 else []))
            yield pd.DataFrame(rows, columns=["doc_id", "mark", "h", "w", "pos", "cores"])

    return make


def judge(n: int, kinds: list[int], cores: list[str], hits: list[tuple[int, list[str]]]) -> tuple[int, int, int, int]:
    """(covered tokens, slots, slots against the substitution, changed slots)
    of the windows on one diagonal."""
    doc: dict[int, str] = {}
    for at, words in hits:
        doc.update(zip(range(at, at + len(words)), words))
    pairs = [(kinds[i], cores[i], doc[i]) for i in doc if kinds[i] != _WORD]
    to, back = {}, {}
    for k, a, b in pairs:
        to.setdefault((k, a), Counter())[b] += 1
        back.setdefault((k, b), Counter())[a] += 1
    fits = lambda k, a, b: max(to[k, a], key=lambda x: (to[k, a][x], x)) == b and max(
        back[k, b], key=lambda x: (back[k, b][x], x)
    ) == a
    off = sum(not fits(*p) for p in pairs)
    return len(doc), len(pairs), off, sum(a != b for _, a, b in pairs)


def needed(n: int) -> int:
    return min(n, ENOUGH, max(WINDOW, math.ceil(n / 2)))


def _mark():
    """Names a row's text, for rows that share an id or have none."""
    return F.md5(text_or_empty().cast("binary"))


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, bits: int) -> DataFrame:
    """The matches of every different document (doc_id, mark) and item text."""
    spark = prepared(docs.sparkSession)
    texts_of = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).distinct()
    items = staged(texts_of.withColumn("item", F.monotonically_increasing_id()), "bench-items")
    schema = "h long, w int, item long, ipos int, n int, kinds array<int>, cores array<string>"
    bench = staged(
        items.mapInPandas(_bench_rows(window, False), schema)
        .unionByName(items.mapInPandas(_bench_rows(window, True), schema))
        .unionByName(items.mapInPandas(_raw_rows(window), schema)),
        "bench-windows",
    )
    widths = sorted(r["w"] for r in bench.select("w").distinct().collect())  # at most 2 * `window` values
    sieve = spark.sparkContext.broadcast(_sieve(bench.select("h"), bits))  # 2 ** bits bits
    # ids as text: pandas has no whole numbers beside nulls
    texts = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), _mark().alias("mark"), text_or_empty().alias("text"))
    found = texts.mapInPandas(
        _found(widths, sieve, bits, window), "doc_id string, mark string, h long, w int, pos int, cores array<string>"
    )
    on = bench.select("h", "w", "item", "ipos")
    raw = (F.col("w") < 0).alias("raw")
    doc = ["doc_id", "mark"]
    joined = found.join(on, ["h", "w"]).select(
        *doc, "item", raw, (F.col("pos") - F.col("ipos")).alias("diagonal"), F.struct("ipos", "cores").alias("hit")
    )
    # a diagonal holds at most one window per position of the item and level
    lines = joined.groupBy(*doc, "item", "raw", "diagonal").agg(F.collect_set("hit").alias("hits"))
    of_item = bench.groupBy("item", raw).agg(
        F.max("n").alias("n"), F.min_by("kinds", "ipos").alias("kinds"), F.min_by("cores", "ipos").alias("item_cores")
    )

    def verdict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, mark, item, raw, n, kinds, cores, hits in zip(
                b["doc_id"], b["mark"], b["item"], b["raw"], b["n"], b["kinds"], b["item_cores"], b["hits"]
            ):
                if raw:
                    covered = len({i for h in hits for i in range(h["ipos"], h["ipos"] + min(n, window))})
                    if covered >= needed(n):
                        rows.append((doc, mark, item, True, covered, n, 0, 0))
                    continue
                covered, slots, off, changed = judge(n, list(kinds), list(cores), [(h["ipos"], list(h["cores"])) for h in hits])
                if covered >= needed(n) and off <= SLACK * slots:
                    rows.append((doc, mark, item, False, covered, n, slots, changed))
            yield pd.DataFrame(rows, columns=["doc_id", "mark", "item", "raw", "covered", "item_tokens", "slots", "changed"])

    good = lines.join(of_item, ["item", "raw"]).mapInPandas(
        verdict,
        "doc_id string, mark string, item long, raw boolean, covered int, item_tokens int, slots int, changed int",
    )
    return good.join(items.select("item", "item_id"), "item").withColumn("doc_id", F.col("doc_id").cast("long"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, bits: int = SIEVE_BITS) -> DataFrame:
    """(doc_id, item_id, covered, item_tokens, slots, changed) of every
    document and item that match; the best diagonal of each pair.

    Null texts are empty and match nothing, as do items of punctuation only.
    Items under LEAST tokens, and those made mostly of numbers, units or names,
    match as they are: whole if they are shorter than ``window`` words, else as
    much of them as of others; their tokens then count operators, and slots and
    changed are 0.  Rows that repeat an id are looked at each with its own
    text, documents and items alike, and give one row of their id, the best
    match; rows without an id count under a null id.  Further columns are
    ignored."""
    best = F.max(F.struct(~F.col("raw"), "covered", -F.col("changed"), "item_tokens", "slots", "changed"))
    return (
        _judged(docs, benchmark, window, bits)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("b"))
        .select("doc_id", "item_id", "b.covered", "b.item_tokens", "b.slots", "b.changed")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text matches no item (all their columns), whatever their
    ids; of rows that share an id those that match go."""
    found = _judged(docs, benchmark, WINDOW, SIEVE_BITS)
    bad = staged(found.select(F.col("doc_id").alias("id"), "mark").distinct(), "contaminated")
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), _mark().alias("mark"))
    same = own["id"].eqNullSafe(bad["id"]) & (own["mark"] == bad["mark"])
    return own.join(bad, same, "left_anti").select("row.*")

"""Information-theoretic sanitisation of personal data.

Base: emails, IP addresses, payment cards and phone numbers by pattern and
check.  These are the protected entities.  The method then asks which other
terms give an entity away: over the corpus, the information a term t carries
about an entity e is PMI(t; e) = log2 p(e | t) / p(e), at most IC(e) =
-log2 p(e).  Their ratio is t's disclosure of e.  Terms found near an entity
(CONTEXT words to either side) in at least SUPPORT different texts are
candidates; p(e | t) is the share of all documents with t that have t near e.
A term whose largest disclosure reaches GENERALISE is replaced by its first
letters and '*', one that reaches REMOVE by nothing, wherever it occurs.

All counts are over whole documents and aggregated before they are shuffled;
context windows keep the work linear in the number of entities.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import prepared, staged, text_or_empty

CONTEXT = 20
SUPPORT = 2
GENERALISE = 0.9
REMOVE = 0.99
#: Rows (under 100 bytes each) up to which a table of terms or hits is sent to every task.
BROADCAST_ROWS = 200_000
KINDS = ("email", "ip", "card", "phone", "term")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# a run of digits is tried from its start only: later starts would fail alike
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+")


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed.  Per
    kind the leftmost matches that do not overlap; those that fail their check
    are left out and not retried."""
    out = []
    if "@" in text:
        done = 0
        for m in _DOMAIN.finditer(text):
            # the longest run of local characters before the sign, not into the last match
            head = text[done : m.start()]
            n = len(head) - len(head.rstrip(_LOCAL))
            if n:
                out.append(("email", m.start() - n, m.end()))
                done = m.end()
            else:
                done = max(done, m.start() + 1)
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(d) <= 19 and _luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _value(kind: str, found: str) -> str:
    return f"{kind}:" + (re.sub(r"[^0-9]", "", found) if kind in ("card", "phone") else found.lower())


def _outside(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, word) of the words that touch no span."""
    out, i, reach = [], 0, 0
    for m in _TERM.finditer(text):
        while i < len(spans) and spans[i][1] <= m.start():
            reach = max(reach, spans[i][2])
            i += 1
        if m.start() >= reach and not (i < len(spans) and spans[i][1] < m.end()):
            out.append((m.start(), m.end(), m[0]))
    return out


def contexts(text: str, width: int = CONTEXT) -> list[tuple[str, list[str]]]:
    """(entity, terms within ``width`` words of it) of every base span; words
    that lie in a base span are no terms."""
    spans = base_spans(text)
    if not spans:
        return []
    free = _outside(text, spans)
    starts = [s for s, _, _ in free]
    out = []
    for kind, s, e in spans:
        a, b = bisect_left(starts, s), bisect_left(starts, e)
        out.append((_value(kind, text[s:e]), [w for _, _, w in free[max(0, a - width) : a] + free[b : b + width]]))
    return out


def _suspect(col="text"):
    """Texts that can hold a base span; others are not sent to Python."""
    return text_or_empty(col).rlike(r"[0-9@]")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def revealing_terms(docs: DataFrame, support: int = SUPPORT, threshold: float = GENERALISE) -> DataFrame:
    """(term, disclosure) of the terms whose disclosure of some entity reaches
    the threshold.  docs: (doc_id, text); terms are in lower case."""
    prepared(docs.sparkSession)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for row, text in zip(b["row"], b["text"]):
                rows += [(row, entity, terms) for entity, terms in contexts(text)]
            yield pd.DataFrame(rows, columns=["row", "entity", "terms"])

    # a row is named by its id and text, so repeated rows count as one document
    own = docs.select(F.xxhash64("doc_id", text_or_empty()).alias("row"), text_or_empty().alias("text"))
    found = own.where(_suspect()).mapInPandas(near, "row long, entity string, terms array<string>")
    by_text = own.where(_suspect()).select("row", F.xxhash64("text").alias("tid"))
    found = staged(found, "pii-contexts")
    tids = staged(by_text.join(found.select("row").distinct(), "row", "left_semi").distinct(), "pii-texts")
    n = float(max(1, docs.count()))
    seen = found.select("row", "entity").distinct().join(tids, "row")
    entities = (
        seen.groupBy("entity")
        .agg(F.countDistinct("row").alias("docs"), F.countDistinct("tid").alias("texts"))
        .where(F.col("texts") >= support)
        .select("entity", "docs")
    )
    pairs = (
        found.join(entities.select("entity"), "entity", "left_semi")
        .select("row", "entity", F.explode(F.transform("terms", lambda t: F.lower(t))).alias("term"))
        .distinct()
        .join(tids, "row")
        .groupBy("entity", "term")
        .agg(F.countDistinct("row").alias("co"), F.countDistinct("tid").alias("texts"))
        .where(F.col("texts") >= support)
        .select("entity", "term", "co")
    )
    pairs = staged(pairs, "pii-pairs")
    candidates = staged(pairs.select("term").distinct(), "pii-candidates")
    df = (
        _terms(own.select("row", "text"))
        .join(_small(candidates), "term", "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    ic = F.log2(F.lit(n) / F.col("docs"))
    disclosure = F.when(ic > 0, 1 + F.log2(F.least(F.col("co") / F.col("df"), F.lit(1.0))) / ic).otherwise(0.0)
    scored = pairs.join(entities, "entity").join(df, "term").withColumn("disclosure", disclosure)
    return scored.groupBy("term").agg(F.max("disclosure").alias("disclosure")).where(F.col("disclosure") >= threshold)


def _terms(rows: DataFrame) -> DataFrame:
    """One row (row, term) for each different term of a text."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    return rows.select("row", F.explode(words).alias("term")).where("term <> ''")


def _mark(text: str, spans: list[tuple[str, int, int]], level: dict[str, float], remove: float) -> str:
    """The text with entities replaced by their kind, terms generalised or
    removed.  Entities that overlap are replaced together, by the first's kind."""
    out, at = [], 0
    whole: list[list] = []
    for kind, s, e in spans:
        if whole and s < whole[-1][2]:
            whole[-1][2] = max(whole[-1][2], e)
        else:
            whole.append([kind, s, e])
    for kind, s, e in whole:
        out.append(text[at:s])
        if kind != "term":
            out.append(f"[{kind.upper()}]")
        elif level[text[s:e].lower()] < remove:
            out.append(text[s : s + max(1, (e - s) // 3)] + "*")
        at = e
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(doc_id, base, spans, clean): base and all spans (kind, start, end; code
    points, end exclusive; by start, then kind), and the sanitised text.

    Null text is empty: no spans, empty text.  Rows that repeat an id or lack
    one are documents of their own.  Further columns are ignored."""
    prepared(docs.sparkSession)
    flagged = staged(revealing_terms(docs, support, generalise), "pii-terms")
    own = docs.select("doc_id", text_or_empty().alias("text"), F.xxhash64("doc_id", text_or_empty()).alias("row"))
    hits = (
        _terms(own.select("row", "text"))
        .join(_small(flagged), "term")
        .groupBy("row")
        .agg(F.collect_set(F.struct("term", "disclosure")).alias("terms"))  # at most the terms of a text
    )
    hits = staged(hits, "pii-hits")
    joined = own.join(_small(hits), "row", "left")
    sent = F.when(_suspect() | F.col("terms").isNotNull(), F.col("text"))
    span = "array<struct<kind:string,start:int,end:int>>"

    @F.pandas_udf(f"base {span}, spans {span}, clean string")
    def find(texts: pd.Series, terms: pd.Series) -> pd.DataFrame:
        rows = []
        for text, own in zip(texts, terms):
            if text is None:
                rows.append(([], [], None))
                continue
            base = base_spans(text)
            level = {t["term"]: t["disclosure"] for t in own} if own is not None else {}
            more = [("term", s, e) for s, e, w in _outside(text, base) if w.lower() in level] if level else []
            spans = sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))
            d = lambda x: [{"kind": k, "start": s, "end": e} for k, s, e in x]
            rows.append((d(base), d(spans), _mark(text, spans, level, remove)))
        return pd.DataFrame(rows, columns=["base", "spans", "clean"])

    done = joined.select("doc_id", "text", find(sent, F.col("terms")).alias("f"))
    return done.select("doc_id", "f.base", "f.spans", F.coalesce("f.clean", "text").alias("clean"))


def joined_spans(col: str):
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, checksum of the base spans and all spans as text."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS[:4]],
        F.sha2(joined_spans("base").cast("binary"), 256).alias("base_sha256"),
        joined_spans("spans").alias("spans"),
    )


def base_sha256(text: str) -> str:
    """The checksum of one text, for tests."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base_spans(text)).encode()).hexdigest()

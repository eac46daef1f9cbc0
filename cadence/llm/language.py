"""Language id by Bayesian evidence fusion.

For every page the log posterior of a language is the sum of four parts:

* text: a naive Bayes model of character n-grams, its evidence tempered since
  n-grams of one text are not independent;
* declared markup language and address suffix (top-level domain and first path
  segment): the log probability of the value given the language, estimated
  from all pages by grouped aggregation and smoothed towards the value's share;
* host prior: language shares of the host, smoothed towards those of its
  registered domain, these towards the top-level domain's, these towards all
  pages'; a page's own vote is left out of its host's counts.

Votes are the text-only posteriors, so nothing but the text model is trained on
labels.  Host tables are aggregated before they are shuffled and joined.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import prepared, staged, text_or_empty
from cadence.llm.webarchive import declared_language, plain_text

SAMPLE_ROWS = 4000
MAX_GRAMS = 4000
TEMPER = 0.1
KAPPA = 5.0
SMOOTH = 2.0
BROADCAST_ROWS = 200_000
_SPACE = re.compile(r"[\W\d_]+")


def grams(text: str) -> Counter:
    """Character 1- to 3-grams of the words."""
    out: Counter = Counter()
    for w, n in Counter(_SPACE.sub(" ", text.lower()).split()).items():
        s = f" {w} "
        for k in (1, 2, 3):
            for i in range(len(s) - k + 1):
                g = s[i : i + k]
                if g != " ":
                    out[g] += n
    return out


class TextModel:
    """Log probabilities of n-grams by language."""

    def __init__(self, langs: list[str], table: dict[str, list[float]], rare: list[float], prior: list[float]):
        self.langs, self.rare, self.prior = langs, np.array(rare), np.array(prior)
        self.table = {g: np.array(v) for g, v in table.items()}
        self.memo: dict[str, np.ndarray] = {}

    def __getstate__(self):
        return self.__dict__ | {"memo": {}}

    def _word(self, w: str) -> np.ndarray:
        got = self.memo.get(w)
        if got is None:
            got = np.zeros(len(self.langs))
            for g, n in grams(w).items():
                got = got + n * self.table.get(g, self.rare)
            if len(w) <= 40:
                if len(self.memo) > 200_000:
                    self.memo.clear()
                self.memo[w] = got
        return got

    def evidence(self, text: str) -> np.ndarray:
        """Tempered log likelihood by language, less the mean; zeros without words."""
        total = np.zeros(len(self.langs))
        for w, n in Counter(_SPACE.sub(" ", text.lower()).split()).items():
            total = total + n * self._word(w)
        total *= TEMPER
        return total - total.mean() if len(total) else total


def _sample(docs: DataFrame, sample_rows: int) -> DataFrame:
    """(lang, text): at most ``sample_rows`` rows, shared evenly by the
    languages, of each those with the smallest hashes.  A cutoff by the number
    of different rows leaves about twice a language's share to be sorted;
    repeated rows are one."""
    keyed = docs.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    sizes = staged(keyed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")), "language-sizes")
    share = max(1, sample_rows // max(1, sizes.count()))
    cut = sizes.select("lang", (F.lit(2.0 * share + 50) / F.greatest("n", F.lit(1))).alias("part"))
    place = (F.col("h") / F.lit(float(1 << 64))) + 0.5
    near = keyed.join(_small(cut), "lang").where(place <= F.col("part")).dropDuplicates(["lang", "h"])
    order = Window.partitionBy("lang").orderBy("h")
    return near.withColumn("r", F.row_number().over(order)).where(F.col("r") <= share).select("lang", "text")


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, max_grams: int = MAX_GRAMS) -> TextModel:
    """docs: (doc_id, text, lang).  Learns from a bounded sample of every
    language (:func:`_sample`); rows without text or lang teach nothing.  Each
    language gives its most frequent n-grams to the table, ``max_grams``
    shared evenly; what a language holds beside the table is spread evenly
    over the n-grams seen outside it."""
    prepared(docs.sparkSession)
    sample = staged(_sample(docs, sample_rows), "language-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                own.setdefault(lang, Counter()).update(grams(text))
        rows = [(lang, g, n) for lang, c in own.items() for g, n in c.items()]
        yield pd.DataFrame(rows, columns=["lang", "g", "n"])

    counts = sample.repartition(16).mapInPandas(count, "lang string, g string, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    counts = staged(counts, "language-grams")
    size = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # a row a language
    langs = sorted(size)
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "g")
    share = max(1, max_grams // max(1, len(langs)))
    top = counts.withColumn("r", F.row_number().over(most)).where(F.col("r") <= share).select("g").distinct()
    rows = counts.join(top, "g").collect()  # at most max_grams a language
    n = {(r["lang"], r["g"]): r["n"] for r in rows}
    known = sorted({r["g"] for r in rows})
    outside = counts.select("g").distinct().count() - len(known) + 1
    held = {lang: sum(n.get((lang, g), 0) for g in known) for lang in langs}
    logp = lambda lang, c, width: math.log((c + 0.5) / (width * (size[lang] + 0.5 * (len(known) + 1))))
    table = {g: [logp(lang, n.get((lang, g), 0), 1) for lang in langs] for g in known}
    rare = [logp(lang, size[lang] - held[lang], outside) for lang in langs]
    return TextModel(langs, table, rare, [1 / max(1, len(langs))] * len(langs))


def address(url: str) -> tuple[str, str, str, str]:
    """(host, registered domain, top-level domain, suffix); the suffix is the
    top-level domain and the first path segment if it looks like a language code."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower()
    except ValueError:
        return "", "", "", ""
    labels = host.split(".") if host else []
    first = parts.path.split("/")[1] if "/" in parts.path else ""
    code = first.lower() if re.fullmatch(r"[A-Za-z]{2}(?:-[A-Za-z]{2})?", first) else ""
    tld = labels[-1] if labels else ""
    return host, ".".join(labels[-2:]), tld, f"{tld}/{code}"


def _evidence(pages: DataFrame, model: TextModel) -> DataFrame:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for page_id, url, page in zip(b["page_id"], b["url"], b["html"]):
                e = model.evidence(plain_text(page))
                z = np.exp(e - e.max()) if len(e) else e
                rows.append((page_id, *address(url), declared_language(page) or "", e.tolist(), (z / z.sum()).tolist()))
            out = pd.DataFrame(rows, columns=["page_id", "host", "domain", "tld", "suffix", "declared", "e", "v"])
            yield out.assign(page_id=out["page_id"].astype("Int64"))

    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    return own.mapInPandas(
        read,
        "page_id long, host string, domain string, tld string, suffix string, declared string, e array<double>, v array<double>",
    )


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _votes(k: int, name: str):
    return F.array(*[F.sum(F.col("v")[i]) for i in range(k)]).alias(name)


def identified(pages: DataFrame, model: TextModel) -> DataFrame:
    """(page_id, lang, confidence, text_lang, declared, host).

    Null pages and addresses are empty.  An empty text leaves the decision to
    the other evidence.  Ties go to the first language by name.  Rows that
    repeat an id are pages of their own.  A model without languages gives ''."""
    k = len(model.langs)
    seen = staged(_evidence(pages, model), "language-evidence")
    if not k:
        return seen.select("page_id", F.lit("").alias("lang"), F.lit(0.0).alias("confidence"), F.lit("").alias("text_lang"), "declared", "host")
    total = seen.agg(_votes(k, "c"), F.count(F.lit(1)).alias("n")).first()
    n = max(1, total["n"])
    every = [(x or 0.0) for x in total["c"]]
    share = [(x + 1.0) / (sum(every) + k) for x in every]
    whole = F.array(*[F.lit(x) for x in share])
    mass = F.array(*[F.lit(x) for x in every])
    blend = lambda c, parent: F.transform(
        c, lambda x, i: (x + F.lit(KAPPA) * F.get(parent, i)) / (F.aggregate(c, F.lit(0.0), lambda a, b: a + b) + F.lit(KAPPA))
    )
    # shares by top-level domain and domain, each smoothed towards the level above
    host = staged(seen.groupBy("host", "domain", "tld").agg(_votes(k, "c")), "language-hosts")
    up = lambda df, by: df.groupBy(*by).agg(F.array(*[F.sum(F.col("c")[i]) for i in range(k)]).alias("c"))
    tld = up(host, ["tld"]).select("tld", blend(F.col("c"), whole).alias("p_tld"))
    domain = up(host, ["domain", "tld"]).join(tld, "tld").select("domain", "tld", blend(F.col("c"), F.col("p_tld")).alias("p_domain"))
    prior = staged(
        host.join(domain, ["domain", "tld"]).select("host", "domain", "tld", F.col("c").alias("c_host"), "p_domain"), "language-priors"
    )

    def given(by: str, out: str) -> DataFrame:
        """log P(value | language), smoothed towards the value's share."""
        t = seen.groupBy(by).agg(_votes(k, "c"), F.count(F.lit(1)).alias("m"))
        p = F.transform("c", lambda x, i: F.log((x + F.lit(SMOOTH) * F.col("m") / n) / (F.get(mass, i) + F.lit(SMOOTH))))
        return staged(t.select(by, p.alias(out)), f"language-{by}")

    fused = (
        seen.join(_small(prior), ["host", "domain", "tld"])
        .join(_small(given("declared", "l_declared")), "declared")
        .join(_small(given("suffix", "l_suffix")), "suffix")
        .withColumn("others", F.zip_with("c_host", "v", lambda a, b: F.greatest(a - b, F.lit(0.0))))
        .withColumn("p", blend(F.col("others"), F.col("p_domain")))
    )
    score = F.transform(
        "e", lambda x, i: x + F.get("l_declared", i) + F.get("l_suffix", i) + F.log(F.get(F.col("p"), i))
    )
    names = F.array(*[F.lit(x) for x in model.langs])
    best = lambda a: F.get(names, (F.array_position(a, F.array_max(a)) - 1).cast("int"))
    scored = fused.withColumn("s", score)
    odds = F.aggregate(F.transform("s", lambda x: F.exp(x - F.array_max("s"))), F.lit(0.0), lambda a, b: a + b)
    return scored.select(
        "page_id",
        best(F.col("s")).alias("lang"),
        F.round(1 / odds, 6).alias("confidence"),
        best(F.col("e")).alias("text_lang"),
        "declared",
        "host",
    )

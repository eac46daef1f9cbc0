"""License scans, resampling and the divergence audit against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadence.llm import divergence, licenses, resample
from cadence.llm.perfecthash import PerfectHash, hashes
from cadence.llm.wordscan import ALPHANUMERIC, LETTERS, slices, words
from tests.llm.test_text_ops import DOC, LONG, docs_of


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


# ---- word scanning


def test_words_of_batches():
    rng = random.Random(3)
    pieces = ["a", "B", "é", "ß1", " ", "\n", "-", "[", "`", "{", "\x7f", " ", "x" * 70]
    for _ in range(60):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(12))) for _ in range(rng.randrange(1, 9))]
        got = words(pa.array(["zz", *texts]).cast(pa.binary()).slice(1), ALPHANUMERIC)
        terms = [t.decode() for t in got.terms.to_pylist()]
        assert [[terms[j] for j in got.number[a:b]] for a, b in zip(got.bound, got.bound[1:])] == [plain_words(t) for t in texts]


def test_slices_keep_every_row(monkeypatch):
    import cadence.llm.wordscan as w

    monkeypatch.setattr(w, "SLICE_BYTES", 10)
    texts = [b"", b"abc", b"x" * 40, b"", b"de", b"fgh", b"ijklmno", b""]
    batches = [pa.RecordBatch.from_arrays([pa.array(part, pa.binary())], names=["text"]) for part in (texts[:3], [], texts[3:])]
    cut = list(slices(iter(batches)))
    assert [t for b in cut for t in b.column("text").to_pylist()] == texts
    assert all(b.num_rows == 1 or sum(map(len, b.column("text").to_pylist())) <= 10 for b in cut)


# ---- licenses


def reference_labels(text):
    line = " " + " ".join(plain_words(text)) + " "
    own = {label for label, markup in licenses.TEMPLATES if re.search(licenses._pattern(licenses.parsed(markup)) + " ", line)}
    return own | {label for label, phrase in licenses.BASE if f" {phrase} " in line}


def render(rng, sequence):
    """Words that a template accepts."""
    out = []
    for x in sequence:
        if isinstance(x, str):
            out.append(x)
        elif x[0] == "optional":
            out += render(rng, x[1]) if rng.random() < 0.5 else []
        else:
            out += [rng.choice(["acme", "the", "software", "2024"]) for _ in range(rng.randint(x[1], x[2]))]
    return out


def test_license_templates_against_patterns(spark):
    rng = random.Random(8)
    texts, wholes = [None, "", " \n.", LONG, "MIT license", "submit licenses", "CC BY", "cc-by, the MIT\nLicense; mit license"], {}
    for label, markup in licenses.TEMPLATES:
        for _ in range(6):
            own = render(rng, licenses.parsed(markup))
            wholes[len(texts)] = label
            texts.append("Ab " + " ".join(w.upper() if rng.random() < 0.3 else w for w in own) + ". tail")
            i = rng.randrange(len(own))
            texts.append(" ".join([*own[:i], "other", *own[i + 1 :]]))
            texts.append(" ".join(own[:i] + own[i + 1 :]))
            texts.append(" ".join([*own[:i], own[i], "added", *own[i + 1 :], *own]))
    got = {r["doc_id"]: r for r in licenses.digest(licenses.scanned(docs_of(spark, texts, extra=True))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert set(filter(None, got[i]["labels"].split(","))) == reference_labels(t), t
        assert got[i]["n_words"] == len(plain_words(t))
        w = plain_words(t)
        at = [(k, label) for label, p in licenses.BASE for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert got[i]["n_base"] == len(at)
        assert got[i]["first_word"] == (min(at)[0] if at else None) and got[i]["last_word"] == (max(at)[0] if at else None)
        assert got[i]["base_labels"] == ",".join(sorted({x for _, x in at}))
    for i, label in wholes.items():
        assert label in got[i]["labels"].split(",") and got[i]["score"] == 1.0
    assert got[0]["score"] == got[3]["score"] == 0.0 and got[4]["score"] == 0.5


def test_license_places_and_mistakes_in_templates(spark):
    text = "x Released under the MIT License. y " * 2
    rows = licenses.scanned(docs_of(spark, [text], ids=[7])).collect()
    own = [(p["label"], p["first"], p["last"]) for p in rows[0]["places"] if not p["base"]]
    assert own == [("mit", 1, 5), ("mit", 8, 12)]
    with pytest.raises(ValueError):
        licenses.parsed("a <<beginOptional>> b")
    with pytest.raises(ValueError):
        licenses.Automaton([("x", "<<beginOptional>>b<<endOptional>>", False)])
    with pytest.raises(ValueError):
        licenses.Automaton([("x", "<<var;words=1-2>> b", False)])
    assert licenses.scanned(spark.createDataFrame([], DOC)).count() == 0
    repeated = spark.createDataFrame([(1, "MIT license", "en", "s", 1)] * 2 + [(None, "cc by", None, None, None)], DOC)
    assert [r["n_base"] for r in licenses.digest(licenses.scanned(repeated)).orderBy("doc_id").collect()] == [1, 1, 1]


def test_license_automaton_forgets_rows():
    auto = licenses.Automaton(list(licenses.standard()), most=3)
    full = licenses.Automaton(list(licenses.standard()))
    rng = random.Random(2)
    for _ in range(200):
        line = np.array([rng.randrange(len(full.number) + 1) for _ in range(30)])
        assert auto.places(line, 0) == full.places(line, 0)


# ---- resampling


def plain_resample(texts, ids, target, percent=5, least=20):
    def features(t):
        w = plain_words(t)
        return [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(bucket(f) for x in texts for f in features(x)), Counter(bucket(f) for x in target for f in features(x))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000))))
    rows = []
    for i, x in zip(ids, texts):
        fs = features(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in fs)
        rows.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((-r[3], r[0], k) for k, r in enumerate(rows) if r[0] is not None and len(plain_words(texts[k])) >= least)
    rank = {k: n + 1 for n, (_, _, k) in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r, rank.get(k)) for k, r in enumerate(rows)), key=str)


def some_texts(n, seed=5):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdé1") for _ in range(rng.randint(1, 6))) for _ in range(80)] + ["ü" * 40, "x" * 64, "y" * 65]
    return [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_resampled_against_brute_force(spark):
    texts = [None, "", "one", "-", LONG, "A b\tC", *some_texts(300)]
    texts += texts[50:60]
    ids = list(range(len(texts)))
    ids[-1] = None
    bench = [None, "", *some_texts(20, 9)]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(bench)], "item_id long, text string")
    want = plain_resample(texts, ids, bench)
    for bracket in (200_000, 7):
        got = resample.resampled(docs_of(spark, texts, extra=True, ids=ids).drop("score"), target, bracket_rows=bracket)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_resampled_edges(spark):
    target = spark.createDataFrame([], "item_id long, text string")
    assert resample.resampled(spark.createDataFrame([], DOC), target).count() == 0
    long = " ".join(f"w{i}" for i in range(25))
    rows = [(i // 3, long, "en", "s", 1) for i in range(120)]  # every row three times
    got = resample.resampled(spark.createDataFrame(rows, DOC), target, bracket_rows=2).collect()
    assert len(got) == 120
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, 7))
    best = sorted(got, key=lambda r: (-r["score"], r["doc_id"]))
    assert sorted((r["score"], r["doc_id"]) for r in got if r["rank"]) == sorted((r["score"], r["doc_id"]) for r in best[:6])


@pytest.mark.parametrize("kind", ["spread", "two", "one"])
def test_cutoff_of_tied_scores(spark, kind):
    score = {"spread": lambda i: i * 37 % 1000, "two": lambda i: i % 2, "one": lambda i: 5}[kind]
    rows = [(score(i), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "score long, doc_id long")
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    for place in (1, 2, 777, 1000, 1001, 1999, 2000):
        assert resample.cutoff(df, place, bracket_rows=10) == order[place - 1]
    ranked = resample.ranked(df, ranked_rows=100).collect()
    assert sorted(((r["score"], r["doc_id"]), r["rank"]) for r in ranked) == sorted((r, i + 1) for i, r in enumerate(order))


# ---- perfect hashes


def test_perfect_hash_is_minimal_and_exact():
    terms = pa.array([f"t{i}".encode() for i in range(5000)] + ["é".encode(), b""], pa.large_binary())
    made = PerfectHash(terms)
    slots = made.slots(terms, hashes(terms))
    assert sorted(slots.tolist()) == list(range(len(terms)))
    assert made.keys.take(pa.array(slots)).equals(terms)
    others = pa.array([f"u{i}".encode() for i in range(5000)])
    assert (made.slots(others, hashes(others)) == -1).all()
    # words that share a key's hash get no slot, keys that share one keep theirs
    assert (made.slots(others.slice(0, 10), hashes(terms.slice(0, 10))) == -1).all()
    assert len(PerfectHash(pa.array([], pa.large_binary()))) == 0


def test_perfect_hash_of_colliding_keys(monkeypatch):
    import cadence.llm.perfecthash as p

    same = lambda terms: np.array([len(t) % 3 for t in terms.to_pylist()], np.uint64)
    monkeypatch.setattr(p, "hashes", same)
    terms = pa.array([b"a", b"b", b"cc", b"dddd", b"ee"], pa.large_binary())
    made = p.PerfectHash(terms)
    assert sorted(made.slots(terms, same(terms)).tolist()) == [0, 1, 2, 3, 4]
    other = pa.array([b"z", b"zz", b"zzz"], pa.large_binary())
    assert made.slots(other, same(other)).tolist() == [-1, -1, -1]


# ---- divergence


def plain_audit(rows, min_docs=10, top=10):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t))) for t, lang, source in rows]
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, _, ws in docs:
        df[lang].update(set(ws))
    kept = {lang: sorted(t for t, n in c.items() if n >= min_docs) for lang, c in df.items()}
    for lang, source, ws in docs:
        counts[lang, source].update(w for w in ws if df[lang][w] >= min_docs)

    def shares(c, terms):
        total = sum(c[t] for t in terms) + 2 * len(terms)
        return {t: 1 + 10**9 * (c[t] + 2) // total for t in terms}

    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang in {k for k, _ in counts}:
        terms, groups = kept[lang], sorted(s for k, s in counts if k == lang)
        p = {s: shares(counts[lang, s], terms) for s in groups}
        q = shares(sum((counts[lang, s] for s in groups), Counter()), terms)
        for s in groups:
            pair = [(o, sum(f(p[s][t], p[o][t]) for t in terms)) for o in groups if o != s]
            term = [(t, f(p[s][t], q[t])) for t in terms if counts[lang, s][t] and p[s][t] > q[t]]
            for part, own, most in (("pair", pair, None), ("term", term, top)):
                own = sorted(own, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(own)]
    return sorted(out)


def audit_rows(seed=4, n=400, sources=12):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcñ") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None])
        s = rng.randrange(sources)
        ws = [vocab[int(rng.random() ** (1 + s % 3) * 150)] for _ in range(rng.randint(0, 40))]
        rows.append((" ".join(ws).replace("a", rng.choice("aA")), lang, None if s == 0 else f"s{s}"))
    rows += [(None, "en", "empty"), ("", "xx", "only"), ("12 ;", "yy", "a"), ("rare", "yy", "é"), ("rare", "yy", "z"), (LONG, "fr", "s1")]
    return rows + rows[:5]


@pytest.mark.parametrize("shard_terms, room", [(50_000, 64_000_000), (9, 900)])
def test_audit_against_brute_force(spark, shard_terms, room):
    rows = audit_rows()
    df = spark.createDataFrame([(i, t, lang, s, 1) for i, (t, lang, s) in enumerate(rows)], DOC)
    for c in ("n", "term", "slot", "total", "value", "rank", "item", "shard", "p"):
        df = df.withColumn(c, F.lit("x"))
    got = divergence.audited(df, shard_terms=shard_terms, broadcast_bytes=room)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows)


def test_audit_over_tiles_and_blocks(spark):
    rng = random.Random(6)
    rows = [(" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(160)), "en", f"host{i % 70}") for i in range(70)]
    assert len({w for t, _, _ in rows for w in t.split()}) > divergence.BLOCK_SLOTS
    df = spark.createDataFrame([(i, t, lang, s, 1) for i, (t, lang, s) in enumerate(rows)], DOC)
    got = divergence.audited(df, min_docs=1, top=3).collect()
    assert sorted(tuple(r) for r in got) == plain_audit(rows, 1, 3)


def test_audit_of_nothing(spark):
    assert divergence.audited(spark.createDataFrame([], DOC)).count() == 0


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(500):
        total = rng.randrange(1, 9 * 10**15)
        n = rng.randrange(total + 1)
        assert divergence.share(np.array([n, total, 0]), total).tolist() == [10**9 * n // total, 10**9, 0]

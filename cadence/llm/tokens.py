"""Token ids as binary shards: frequency ranks in Stream-VByte form.

Ids are replaced by their frequency rank (the most frequent is 0), so that most
need one byte.  A block keeps the control bytes (two bits an id: its number of
data bytes less one) apart from the data bytes; decoding looks control bytes up
in a table of lengths and masks, all in numpy.

Files: ``ranks.u32`` (id of every rank) and one file a shard, documents in
ascending id order over the shards.  A shard is a run of blocks, then an index:

    block   n_ids u32 | n_data u32 | control bytes | data bytes
    index   n_docs x (doc_id i64 | null flag u8 | n_tokens i64)
    tail    n_docs i64 | offset of the index i64 | b"SVBRANK1"

Each attempt of a task writes a file of its own name and reports it; the
manifest table (committed by Spark) says which files count, so retried or
speculative tasks and lost executors leave at most unlisted files.
"""

from __future__ import annotations

import itertools
import json
import re
import uuid
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.llm.common import prepared, scratch_dir, staged
from cadence.llm.wordscan import buffers, slices, text_bytes

END_ID = 0
SHARD_IDS = 4_000_000
BLOCK_IDS = 1 << 18
ENCODE_BYTES = 8_000_000
MEMO = 1_500_000
MAGIC = b"SVBRANK1"

_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def pack(ranks: np.ndarray) -> bytes:
    """One block of u32 values."""
    wide = int(ranks.max(initial=0)) > 0xFFFF
    r = ranks.astype("<u4" if wide else "<u2")
    code = (r > 0xFF).astype(np.uint8)
    if wide:
        code += (r > 0xFFFF).astype(np.uint8) + (r > 0xFFFFFF)
    quads = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    quads[: len(r)] = code
    q = quads.reshape(-1, 4)
    control = q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6
    octets = r.view(np.uint8).reshape(-1, r.itemsize)
    data = octets[np.arange(r.itemsize, dtype=np.uint8) <= code[:, None]]
    return np.array([len(r), len(data)], "<u4").tobytes() + control.astype(np.uint8).tobytes() + data.tobytes()


def unpack(block: memoryview, at: int = 0) -> tuple[np.ndarray, int]:
    """(u32 values, offset behind the block)."""
    n, size = (int(x) for x in np.frombuffer(block, "<u4", 2, at))
    n_control = -(-n // 4)
    control = np.frombuffer(block, np.uint8, n_control, at + 8)
    data = np.frombuffer(block, np.uint8, size, at + 8 + n_control)
    length = _LENGTHS[control].reshape(-1)[:n]
    start = np.cumsum(length) - length
    v = data[start].astype(np.uint32)
    for k in range(1, int(length.max(initial=1))):  # the further bytes of those that have them
        more = np.flatnonzero(length > k)
        v[more] |= data[start[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return v, at + 8 + n_control + size


#: Marks that end a word; a run of them is one pre-token of its own.
MARKS = ".,;:!?"
#: Bytes of ASCII blanks other than space and line end, and first bytes of wide blanks.
_OTHER_BLANK = np.isin(np.arange(256), [9, 11, 12, 13, 28, 29, 30, 31])
_BLANK_LEAD = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])


def _byte_letters() -> str:
    """The byte-level alphabet, a letter a byte: printable Latin-1 stands for
    itself, other bytes for the letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = itertools.count(256)
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


BYTE_LETTERS = _byte_letters()
SPACE = BYTE_LETTERS[ord(" ")]
#: Pre-tokens of a byte-level vocabulary in printable ASCII text, blanks before words only.
_PRINTABLE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ A-Za-z0-9]+")


def _letters(text: str) -> str:
    return charmap_decode(text.encode(), "strict", BYTE_LETTERS)[0]


@lru_cache(maxsize=4)
def _encoder(path: str, added: bool):
    return Encoder(path, added)


class Encoder:
    """Ids of whole texts.  The pre-tokeniser never joins a non-blank with a
    blank after it, so the ids of a text are those of its pieces, cut before
    each such space, and, in texts whose blanks stand alone, before each line
    end.  A piece keeps its space or line end, so its ids are those
    of its own text.  Ids of pieces seen are kept, up to a bound, in one flat
    array; a batch looks each different piece up once and gathers by numpy.

    With ``added``, special tokens of the vocabulary that stand in a text keep
    their own id, as in a plain call of the library; without, they are text.
    Texts that hold an added token are encoded whole, so none is cut."""

    def __init__(self, path: str, added: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not added
        self.kind = "<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4"
        self.cut = re.compile(r"(?<=\S)(?= )")
        self.cut_lines = re.compile(r"(?=[ \n])")  # where blanks stand alone
        # byte-level vocabularies: the pre-tokens of letter words, runs of marks and
        # printable ASCII pieces go straight to the library's model
        form = json.loads(self.tok.to_str())
        own = [t for t in form["added_tokens"] if added or not t["special"]]
        self.added = [t["content"] for t in own]
        if form["normalizer"] and any(t["normalized"] for t in own):
            self.added = [""]  # found in the normalised text only: every text is encoded whole
        level = form["pre_tokenizer"] or {}
        plain = level.get("type") == "ByteLevel" and level.get("use_regex") and not level.get("add_prefix_space")
        self.direct = bool(plain and not form["normalizer"] and form["model"]["type"] == "BPE")
        self.model = self.tok.model
        self.marks: dict[str, list[int]] = {}
        self.newline = self._model("\n") if self.direct else []
        self._clear()

    def _clear(self) -> None:
        self.memo: dict[str | int, int] = {}  # number of a piece, or of an end id
        self.flat = np.zeros(1 << 16, self.kind)
        self.end = np.zeros(1 << 14, np.int64)  # end[i]: where piece i - 1 ends
        self.n = 0

    def _add(self, ids: list[int], size: list[int]) -> range:
        """The numbers of new pieces, whose ids follow one another."""
        used, more = int(self.end[self.n]), len(ids)
        while used + more > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(size) >= len(self.end):
            self.end = np.concatenate([self.end, np.zeros_like(self.end)])
        self.flat[used : used + more] = ids
        self.end[self.n + 1 : self.n + 1 + len(size)] = used + np.cumsum(size)
        self.n += len(size)
        return range(self.n - len(size), self.n)

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The number of every piece."""
        d = pieces.dictionary_encode()
        keys = d.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.memo.get, keys, itertools.repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(number < 0).tolist()
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            order, ids, size = self._encode([keys[i] for i in part])
            own = [part[i] for i in order]
            numbers = self._add(ids, size)
            self.memo.update(zip([keys[i] for i in own], numbers))
            number[own] = numbers
        return number[d.indices.to_numpy(zero_copy_only=False)]

    def _end(self, end: int) -> int:
        if end not in self.memo:
            self.memo[end] = self._add([end], [1])[0]
        return self.memo[end]

    def _encode(self, pieces: list[str]) -> tuple[list[int], list[int], list[int]]:
        """(an order of the pieces, all their ids in it, number of ids of each)."""
        order, ids, size, rest = [], [], [], []
        if self.direct:
            tokenize, marks, newline = self.model.tokenize, self.marks, self.newline
            for i, piece in enumerate(pieces):
                bare = piece[1:]
                if bare.isalpha() and piece[0] == " ":
                    got = [t.id for t in tokenize(SPACE + bare if bare.isascii() else _letters(piece))]
                    ids += got
                    order.append(i)
                    size.append(len(got))
                    continue
                word = piece.rstrip(MARKS)
                line = word[:1] == "\n"
                bare = word[1:] if line or word[:1] == " " else word
                before = len(ids)
                if bare.isalpha():
                    if line:
                        ids += newline
                        word = bare
                    ids += [t.id for t in tokenize(_letters(word))]
                    if piece[-1] in MARKS:
                        run = piece[len(word) + line :]
                        ids += marks.get(run) or self._marks(run)
                elif piece != " " and piece.isascii() and piece.isprintable() and " " not in piece[1:]:
                    for pre in _PRINTABLE.findall(piece):
                        ids += [t.id for t in tokenize(pre.replace(" ", SPACE))]
                else:
                    rest.append(i)
                    continue
                order.append(i)
                size.append(len(ids) - before)
        else:
            rest = list(range(len(pieces)))
        for i, e in zip(rest, self.tok.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)):
            order.append(i)
            size.append(len(e.ids))
            ids += e.ids
        return order, ids, size

    def _model(self, pre_token: str) -> list[int]:
        return [t.id for t in self.model.tokenize(_letters(pre_token))]

    def _marks(self, run: str) -> list[int]:
        if run not in self.marks:
            if len(self.marks) > 10_000:
                self.marks.clear()
            self.marks[run] = self._model(run) if run else []
        return self.marks[run]

    def batch(self, texts: list[str], end: bytes = b"") -> list[bytes]:
        """The ids of every text, ``end`` behind each."""
        if self.n > MEMO:
            self._clear()
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if whole:
            got = self.tok.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)
            held = {i: np.array(e.ids, self.kind).tobytes() + end for i, e in zip(whole, got)}
            rest = iter(self.batch([t for i, t in enumerate(texts) if i not in held], end) if len(held) < len(texts) else [])
            return [held[i] if i in held else next(rest) for i in range(len(texts))]
        if not texts:
            return []
        parts = []
        for t in texts:
            # plain: every blank is one space or line end between two words
            plain = t.replace("\n", " ") == " ".join(t.split())
            parts.append((self.cut_lines if plain else self.cut).split(t))
        bound = np.r_[0, np.cumsum([len(p) for p in parts])]
        ids, upto = self._gather(self._numbers(pa.array(itertools.chain.from_iterable(parts), pa.large_string())))
        at = upto[bound].tolist()
        return [ids[i:j].tobytes() + end for i, j in zip(at, at[1:])]

    def arrow(self, texts: pa.Array, end: int | None = None) -> pa.Array:
        """The same of binary texts without nulls, ``end`` behind each, as
        binary; texts whose blanks stand alone are cut as arrays of bytes."""
        if self.n > MEMO:
            self._clear()
        plain = self._plain(texts)
        mark = b"" if end is None else np.array([end], self.kind).tobytes()
        made = self._cut(texts if plain.all() else texts.filter(pa.array(plain)), end)
        if plain.all():
            return made
        odd = [t.decode() for t in texts.filter(pa.array(~plain)).to_pylist()]
        order = np.empty(len(texts), np.int64)
        order[np.r_[np.flatnonzero(plain), np.flatnonzero(~plain)]] = np.arange(len(texts))
        return pa.concat_arrays([made, pa.array(self.batch(odd, mark), pa.large_binary())]).take(pa.array(order))

    def _plain(self, texts: pa.Array) -> np.ndarray:
        """Whether all blanks of a text are a space or line end between two
        others, and no added token stands in it."""
        data, offsets = buffers(texts)
        blank = (data == 32) | (data == 10)
        bad = _OTHER_BLANK[data]
        bad[:-1] |= blank[:-1] & blank[1:]
        lead = np.flatnonzero(_BLANK_LEAD[data])
        second, third = (data[np.minimum(lead + k, len(data) - 1)] for k in (1, 2))
        wide = (data[lead] == 0xC2) & ((second == 0x85) | (second == 0xA0))
        wide |= (data[lead] == 0xE2) & (second <= 0x81) & ((third <= 0x8A) | (third >= 0x9F))
        bad[lead[wide | (data[lead] == 0xE1) & (second == 0x9A) | (data[lead] == 0xE3) & (second == 0x80)]] = True
        before = np.searchsorted(np.flatnonzero(bad), offsets)
        ok = before[1:] == before[:-1]
        some = np.flatnonzero(np.diff(offsets))
        ok[some] &= ~(blank[offsets[some]] | blank[offsets[some + 1] - 1])
        for a in self.added:
            ok &= ~pc.match_substring(texts, a.encode()).to_numpy(zero_copy_only=False)
        return ok

    def _cut(self, texts: pa.Array, end: int | None) -> pa.Array:
        data, offsets = buffers(texts)
        begins = (data == 32) | (data == 10)
        begins[offsets[offsets < len(data)]] = True
        start = np.flatnonzero(begins)
        bound = np.searchsorted(start, offsets)
        places = np.append(start, len(data)).astype(np.int64)
        number = self._numbers(pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(places), pa.py_buffer(data)))
        if end is not None:
            number = np.insert(number, bound[1:], self._end(end))
            bound = bound + np.arange(len(bound))
        ids, upto = self._gather(number)
        places = (upto[bound] * ids.itemsize).astype(np.int64)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(places), pa.py_buffer(ids)])

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces, where each begins and the last one ends)."""
        start = self.end[numbers]
        size = self.end[numbers + 1] - start
        upto = np.r_[0, np.cumsum(size)]
        return self.flat[np.repeat(start - upto[:-1], size) + np.arange(upto[-1])], upto


def encoded(docs: DataFrame, path: str, end_id: int | None = END_ID, added: bool = False) -> DataFrame:
    """(doc_id, ids): little-endian ids of every whole text, u2 if the
    vocabulary allows, else u4; null text is empty; ``added`` as in Encoder."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, added)
        for part in slices(batches, most=ENCODE_BYTES):
            ids = enc.arrow(part.column("text"), end_id).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], names=["doc_id", "ids"])

    return text_bytes(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(run, "doc_id long, ids binary")


def _id_kind(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def _open(uri: str, mode: str):
    """A stream in the shared folder, whatever store holds it."""
    from pyarrow import fs

    local = re.fullmatch(r"(?:file:(?://)?)?(/.*)", uri)
    store, at = (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(uri)
    return store.open_output_stream(at, compression=None) if mode == "w" else store.open_input_file(at)


def rank_table(ids: DataFrame, kind: str) -> np.ndarray:
    """Ids by falling frequency (ties: smaller id); one row an id of the vocabulary."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for b in batches:
            joined = np.frombuffer(b"".join(b["ids"]), kind)
            got = np.bincount(joined, minlength=len(total))
            got[: len(total)] += total
            total = got
        at = np.flatnonzero(total)
        yield pd.DataFrame({"id": at, "n": total[at]})

    rows = (
        ids.select("ids")
        .mapInPandas(count, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "id")
        .collect()  # at most one row an id of the vocabulary
    )
    return np.array([r["id"] for r in rows], dtype="<u4")


def write_shards(ids: DataFrame, kind: str, folder: str, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes the files of ``ids`` (doc_id, ids) and returns the manifest
    (shard, file, n_docs, n_ids), shards in document order.  Nulls come first;
    rows that repeat an id are ordered by their ids' bytes."""
    spark = ids.sparkSession
    by_rank = rank_table(ids, kind)
    with _open(f"{folder}/ranks.u32", "w") as f:
        f.write(by_rank.tobytes())
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, "<u4")
    rank_of[by_rank] = np.arange(len(by_rank), dtype="<u4")
    ranks = spark.sparkContext.broadcast(rank_of)  # one entry an id of the vocabulary
    width = np.dtype(kind).itemsize
    total = ids.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    shards = max(1, -(-total // width // shard_ids))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex[:12]}.svb"
        index, held, n_ids, at, out = [], [], 0, 0, None

        def flush(last: bool) -> None:
            nonlocal held, at
            joined = np.concatenate(held) if held else np.zeros(0, kind)
            full = len(joined) if last else len(joined) // BLOCK_IDS * BLOCK_IDS
            for i in range(0, full, BLOCK_IDS):
                block = pack(ranks.value[joined[i : min(full, i + BLOCK_IDS)]])
                out.write(block)
                at += len(block)
            held = [joined[full:]]

        waiting = 0
        for b in batches:
            for doc, raw in zip(b["doc_id"], b["ids"]):
                if out is None:
                    out = _open(name, "w")
                own = np.frombuffer(raw, kind)
                index.append((0, 1, len(own)) if pd.isna(doc) else (int(doc), 0, len(own)))
                held.append(own)
                n_ids += len(own)
                waiting += len(own)
                if waiting >= BLOCK_IDS:
                    flush(False)
                    waiting = len(held[0])
        if out is None:
            return
        flush(True)
        out.write(_index_bytes(index))
        out.write(np.array([len(index), at], "<i8").tobytes() + MAGIC)
        out.close()
        yield pd.DataFrame([(shard, name, len(index), n_ids)], columns=["shard", "file", "n_docs", "n_ids"])

    placed = ids.repartitionByRange(int(shards), F.col("doc_id"), F.crc32("ids")).sortWithinPartitions(
        "doc_id", F.crc32("ids"), "ids"
    )
    return staged(placed.mapInPandas(write, "shard int, file string, n_docs long, n_ids long"), "tokens-manifest")


_INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<i8")])


def _index_bytes(index: list[tuple[int, int, int]]) -> bytes:
    return np.array(index, dtype=_INDEX).tobytes()


def read_shard(path: str, by_rank: np.ndarray) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    """(doc_id, its ids in parts) of every document of a file, in order; one
    block is held at a time."""
    with _open(path, "r") as f:
        size = f.size()
        f.seek(size - 24)
        tail = f.read(24)
        if tail[16:] != MAGIC:
            raise ValueError(f"{path} is not a token shard")
        n_docs, at_index = (int(x) for x in np.frombuffer(tail, "<i8", 2))
        f.seek(at_index)
        index = np.frombuffer(f.read(n_docs * _INDEX.itemsize), _INDEX)
        f.seek(0)
        left, at = np.zeros(0, "<u4"), 0
        for doc, null, n in index.tolist():
            parts, need = [], n
            while need:
                if not len(left):
                    head = f.read(8)
                    k, d = (int(x) for x in np.frombuffer(head, "<u4"))
                    ranks, _ = unpack(memoryview(head + f.read(-(-k // 4) + d)))
                    left = by_rank[ranks]
                parts.append(left[:need])
                left = left[len(parts[-1]) :]
                need -= len(parts[-1])
            yield (None if null else doc), parts


def read_back(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    with _open(f"{folder}/ranks.u32", "r") as f:
        by_rank = spark.sparkContext.broadcast(np.frombuffer(f.read(), "<u4"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # one small row a shard
    based = staged(manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "tokens-bases")
    files = max(1, based.count())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, start in zip(b["file"], b["base"]):
                rows = []
                for doc, parts in read_shard(path, by_rank.value):
                    crc, n = 0, 0
                    for p in parts:
                        crc = zlib.crc32(p.astype("<u4").tobytes(), crc)
                        n += len(p)
                    rows.append((doc, start, n, crc))
                    start += n
                    if len(rows) >= 10_000:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    return based.repartition(files).mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(rows: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    df["doc_id"] = pd.array(df["doc_id"].tolist(), dtype="Int64")
    return df


def tokenised(docs: DataFrame, path: str, end_id: int | None = END_ID, added: bool = False) -> DataFrame:
    """Encode, write the binary files, read them back; one row a document.

    Null and empty texts hold the end id alone.  Rows that repeat an id are
    kept as documents of their own; rows without an id come first.  No rows:
    no files but an empty rank table, no rows.  ``added``: special tokens in a
    text keep their own id, as in a plain call of the library."""
    spark = prepared(docs.sparkSession)
    kind = _id_kind(path)
    ids = staged(encoded(docs, path, end_id, added), "tokens-ids", "zstd")
    folder = scratch_dir(spark, "tokens-files")
    return read_back(spark, write_shards(ids, kind, folder), folder)

"""Frame byte packing / unpacking, vectorised over whole Arrow batches.

Spark has no built-in to read a little-endian int32 or reinterpret bytes as
float32, and doing the envelope with hex/substring expressions makes the
optimiser inline the whole chain into every reference.  So the byte work is
two scalar Arrow UDFs — numpy gathers over the batch's contiguous buffers, no
per-row Python — while JSON parsing and validity checks stay in Catalyst.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

ENVELOPE = T.StructType(
    [
        T.StructField("n_bytes", T.IntegerType()),
        T.StructField("header_len", T.IntegerType()),
        T.StructField("header_text", T.StringType()),
        T.StructField("payload_bytes", T.IntegerType()),
        T.StructField("samples", T.ArrayType(T.FloatType())),
    ]
)


def _offsets(arr: pa.Array) -> np.ndarray:
    width = np.int64 if pa.types.is_large_binary(arr.type) or pa.types.is_large_string(arr.type) else np.int32
    return np.frombuffer(arr.buffers()[1], dtype=width)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)


def _raw(arr: pa.Array) -> np.ndarray:
    buf = arr.buffers()[2]
    return np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)


def _valid(arr: pa.Array) -> np.ndarray:
    if arr.null_count == 0:
        return np.ones(len(arr), dtype=bool)
    return np.asarray(arr.is_valid().to_numpy(zero_copy_only=False), dtype=bool)


def _gather(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate raw[starts[i] : starts[i]+lengths[i]] for all i (vectorised)."""
    lengths = np.maximum(lengths, 0)
    offs = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    total = int(offs[-1])
    if total == 0:
        return np.zeros(0, np.uint8), offs
    idx = np.repeat(starts - offs[:-1], lengths) + np.arange(total, dtype=np.int64)
    return raw[idx], offs


def _validity_buffer(valid: np.ndarray):
    if valid.all():
        return None
    return pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())


@arrow_udf(ENVELOPE)
def split_frames(value: pa.Array) -> pa.Array:
    """Message bytes → (n_bytes, header_len, header_text, payload_bytes,
    samples).  header_text is NULL when the length field points outside the
    message; samples is NULL unless the payload is whole float32s."""
    n = len(value)
    offs = _offsets(value)
    raw = _raw(value)
    ok = _valid(value)
    nbytes = np.diff(offs)
    has_len = ok & (nbytes >= 4)
    # little-endian int32 at each message start
    hl = np.zeros(n, dtype=np.int64)
    if has_len.any():
        b = _gather(raw, np.where(has_len, offs[:-1], 0), np.where(has_len, 4, 0))[0].reshape(-1, 4)
        hl[has_len] = b.copy().view("<i4").reshape(-1).astype(np.int64)
    hdr_ok = has_len & (hl > 0) & (hl + 4 <= nbytes)
    h_bytes, h_offs = _gather(raw, offs[:-1] + 4, np.where(hdr_ok, hl, 0))
    header_text = pa.StringArray.from_buffers(
        n, pa.py_buffer(h_offs.astype(np.int32).tobytes()), pa.py_buffer(h_bytes.tobytes()), _validity_buffer(hdr_ok)
    )
    pay_len = np.where(hdr_ok, nbytes - 4 - hl, 0)
    pay_ok = hdr_ok & (pay_len % 4 == 0)
    p_bytes, _ = _gather(raw, offs[:-1] + 4 + hl, np.where(pay_ok, pay_len, 0))
    floats = p_bytes.view("<f4").astype(np.float32, copy=False) if p_bytes.size else np.zeros(0, np.float32)
    counts = np.where(pay_ok, pay_len // 4, 0)
    l_offs = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    samples = pa.ListArray.from_arrays(pa.array(l_offs), pa.array(floats, type=pa.float32()), mask=pa.array(~pay_ok))
    to_i32 = lambda x, m: pa.array(np.where(m, x, 0).astype(np.int32), mask=~m)
    return pa.StructArray.from_arrays(
        [to_i32(nbytes, ok), to_i32(hl, has_len), header_text, to_i32(pay_len, hdr_ok), samples],
        fields=[pa.field(f.name, t) for f, t in zip(ENVELOPE.fields, [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.float32())])],
    )


@arrow_udf(T.BinaryType())
def pack_frames(header_text: pa.Array, samples: pa.Array) -> pa.Array:
    """(JSON header text, float array) → int32 LE length | UTF-8 header |
    float32 LE payload.  NULL when either input is NULL."""
    n = len(header_text)
    if isinstance(header_text, pa.ChunkedArray):
        header_text = header_text.combine_chunks()
    h_offs = _offsets(header_text)
    h_raw = _raw(header_text)
    h_len = np.diff(h_offs)
    ok = _valid(header_text) & _valid(samples)
    vals = np.asarray(samples.flatten().to_numpy(zero_copy_only=False), dtype="<f4")
    s_cnt = np.asarray(samples.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    s_offs = np.concatenate([[0], np.cumsum(s_cnt)]).astype(np.int64)
    p_len = s_cnt * 4
    msg_len = np.where(ok, 4 + h_len + p_len, 0)
    out_offs = np.concatenate([[0], np.cumsum(msg_len)]).astype(np.int64)
    out = np.zeros(int(out_offs[-1]), dtype=np.uint8)
    starts = out_offs[:-1]
    # length prefix
    len_bytes = h_len.astype("<i4").view(np.uint8).reshape(-1, 4)
    for j in range(4):
        out[starts[ok] + j] = len_bytes[ok, j]
    # header bytes
    hb, _ = _gather(h_raw, h_offs[:-1], np.where(ok, h_len, 0))
    dst, _ = _gather(np.arange(out.size, dtype=np.int64), starts + 4, np.where(ok, h_len, 0))
    out[dst] = hb
    # payload bytes
    pb, _ = _gather(vals.view(np.uint8), s_offs[:-1] * 4, np.where(ok, p_len, 0))
    dst, _ = _gather(np.arange(out.size, dtype=np.int64), starts + 4 + h_len, np.where(ok, p_len, 0))
    out[dst] = pb
    off_type = np.int32 if out.size < 2**31 else np.int64
    typ = pa.binary() if off_type is np.int32 else pa.large_binary()
    return pa.Array.from_buffers(
        typ, n, [_validity_buffer(ok), pa.py_buffer(out_offs.astype(off_type).tobytes()), pa.py_buffer(out.tobytes())]
    )

"""Payload decoders: block columns, or a decode error, from the bytes of a message.

Formats: headers_only (the message id alone), json_lz4 and cbor_map (a version byte and a CBOR
envelope; its payload is LZ4-framed JSON or a CBOR map), proto_zstd (a zstd frame of a
length-prefixed tag-value message that holds a block header or a shard). proto_zstd is read and
written by columns where a batch's rows are plain, and row by row where they aren't.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.headers import first_value
from ..functions.msgid import parse
from ..schema import ANNOUNCEMENT, BLOCK, MESSAGE_ID, SHARD

FORMATS = ("headers_only", "json_lz4", "cbor_map", "proto_zstd")
VERSION = 1


class DecodeError(ValueError):
    pass


def read_cbor(data: bytes, at: int = 0):
    """(value, where it ends) of one CBOR item: integers, byte and text strings, arrays, maps, simple values and floats."""
    try:
        major, low = data[at] >> 5, data[at] & 31
        at += 1
        if low < 24:
            n = low
        elif low < 28:
            size = 1 << (low - 24)
            n, at = int.from_bytes(data[at : at + size], "big"), at + size
            if at > len(data):
                raise DecodeError("CBOR ends early")
        else:
            raise DecodeError("CBOR length not supported")
    except IndexError:
        raise DecodeError("CBOR ends early") from None
    if major in (0, 1):
        return (n if major == 0 else -1 - n), at
    if major in (2, 3):
        body = data[at : at + n]
        if len(body) < n:
            raise DecodeError("CBOR ends early")
        return (bytes(body) if major == 2 else body.decode()), at + n
    if major == 4:
        out = []
        for _ in range(n):
            value, at = read_cbor(data, at)
            out.append(value)
        return out, at
    if major == 5:
        held = {}
        for _ in range(n):
            key, at = read_cbor(data, at)
            held[key], at = read_cbor(data, at)
        return held, at
    if major == 6:
        return read_cbor(data, at)
    if low in (25, 26, 27):
        return struct.unpack({25: ">e", 26: ">f", 27: ">d"}[low], data[at - (1 << (low - 24)) : at])[0], at
    return {20: False, 21: True}.get(n), at


def write_cbor(value) -> bytes:
    def head(major: int, n: int) -> bytes:
        if n < 24:
            return bytes([major << 5 | n])
        size = next(s for s in range(4) if n < 1 << (8 << s))
        return bytes([major << 5 | 24 + size]) + n.to_bytes(1 << size, "big")

    if isinstance(value, int):
        return head(0, value) if value >= 0 else head(1, -1 - value)
    if isinstance(value, bytes):
        return head(2, len(value)) + value
    if isinstance(value, str):
        return head(3, len(value.encode())) + value.encode()
    if isinstance(value, list):
        return head(4, len(value)) + b"".join(map(write_cbor, value))
    return head(5, len(value)) + b"".join(write_cbor(x) for pair in value.items() for x in pair)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a tag-value message with varint and length-prefixed fields."""

    def varint(at: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            if at >= len(data):
                raise DecodeError("message ends early")
            out, at = out | (data[at] & 127) << shift, at + 1
            if not data[at - 1] & 128:
                return out, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        value, at = varint(at)
        if tag & 7 == 2:
            if at + value > len(data):
                raise DecodeError("message ends early")
            value, at = data[at : at + value], at + value
        elif tag & 7:
            raise DecodeError("field type not supported")
        yield tag >> 3, value


def _message(fields: list[tuple[int, int | bytes]]) -> bytes:
    def varint(n: int) -> bytes:
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    return b"".join(varint(k << 3 | 2) + varint(len(v)) + v if isinstance(v, bytes) else varint(k << 3) + varint(v) for k, v in fields)


def _envelope(data: bytes) -> bytes:
    if not data:
        raise DecodeError("empty payload")
    if data[0] != VERSION:
        raise DecodeError(f"unknown version {data[0]}")
    held, at = read_cbor(data, 1)
    if not isinstance(held, list) or at >= len(data):
        raise DecodeError("no envelope, or nothing in it")
    return data[at:]


def _typed(value, kind, name: str):
    if not isinstance(value, kind) or isinstance(value, bool):
        raise DecodeError(f"{name} is missing or of another type")
    return value


@lru_cache(1)
def _zstd():
    """A worker's decompressor, what it raises, and its compressor."""
    import zstandard

    return zstandard.ZstdDecompressor(), zstandard.ZstdError, zstandard.ZstdCompressor(level=1)


def decode_one(data: bytes | None, kind: str) -> dict:
    """The block fields of one payload; raises DecodeError."""
    data = data or b""
    if kind == "json_lz4":
        body, _ = read_cbor(_envelope(data))
        try:
            with pa.CompressedInputStream(pa.BufferReader(_typed(body, bytes, "payload")), "lz4") as f:
                block = json.loads(f.read())
            head = block["block"]["header"]
        except (OSError, ValueError, KeyError, TypeError) as e:
            raise DecodeError(str(e)[:80]) from None
        return {"height": _typed(head.get("height"), int, "height"), "block_type": ANNOUNCEMENT, "shard_id": 0, "hash": _typed(head.get("hash"), str, "hash"), "prev_hash": _typed(head.get("prev_hash"), str, "prev_hash")}
    if kind == "cbor_map":
        held, _ = read_cbor(_envelope(data))
        held = _typed(held, dict, "payload")
        return {"height": _typed(held.get("height"), int, "height"), "block_type": ANNOUNCEMENT, "shard_id": 0, "hash": _typed(held.get("hash"), str, "hash"), "prev_hash": _typed(held.get("parent_hash"), str, "parent_hash")}
    if kind != "proto_zstd":
        raise DecodeError(f"unknown format {kind}")
    if not data:
        raise DecodeError("empty payload")
    inflate, failed, _ = _zstd()
    try:
        body = inflate.decompressobj().decompress(data)
    except failed as e:
        raise DecodeError(str(e)[:80]) from None
    for number, value in _fields(body):
        if number not in (1, 2) or not isinstance(value, bytes):
            raise DecodeError("neither a header nor a shard")
        f = dict(_fields(value))
        mask = f.get(4)
        text = lambda k: f.get(k, b"").decode("utf-8", "surrogateescape")  # noqa: E731, B023
        return {
            "height": f.get(3, 0), "block_type": ANNOUNCEMENT if number == 1 else SHARD, "shard_id": f.get(5, 0), "hash": text(1), "prev_hash": text(2),
            "shard_mask": None if mask is None else [b > 0 for b in mask],
        }
    raise DecodeError("empty message")


def encode_one(block: dict, kind: str) -> bytes:
    """The payload of a block, for fixtures and round trips."""
    envelope = bytes([VERSION]) + write_cbor([1, block["height"], 0, 0, bytes(16)])
    if kind == "json_lz4":
        text = json.dumps({"block": {"header": {"hash": block["hash"], "prev_hash": block["prev_hash"], "height": block["height"]}}}).encode()
        sink = pa.BufferOutputStream()
        with pa.CompressedOutputStream(sink, "lz4") as f:
            f.write(text)
        return envelope + write_cbor(sink.getvalue().to_pybytes())
    if kind == "cbor_map":
        return envelope + write_cbor({"hash": block["hash"], "parent_hash": block["prev_hash"], "height": block["height"]})
    fields: list = [(1, block["hash"].encode()), (2, block["prev_hash"].encode()), (3, block["height"])]
    if block.get("shard_mask") is not None:
        fields.append((4, bytes(map(int, block["shard_mask"]))))
    if block["block_type"] == SHARD:
        fields.append((5, block["shard_id"]))
    return _zstd()[2].compress(_message([(1 if block["block_type"] == ANNOUNCEMENT else 2, _message(fields))]))


_BLOCK_NAMES = [f.name for f in BLOCK.fields]
_ARROW = (pa.int64(), pa.int8(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.bool_()), pa.string())
#: Longest message, and longest text of one, that is handled by columns.
_LONGEST, _LONGEST_TEXT = 1 << 12, 1 << 8


def _parts(column: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Offsets of an array of texts or bytes, and what they point into."""
    column = column.cast(pa.binary())
    _, offsets, held = column.buffers()
    return np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64), held or pa.py_buffer(b"")


def _inflated(payloads: pa.Array) -> list[bytes]:
    """The messages of whole frames that tell their size; empty where a payload is anything else."""
    import zstandard

    inflate, failed, _ = _zstd()
    offsets, held = _parts(payloads)
    held, bounds, out = memoryview(held), offsets.tolist(), []
    for begin, end in zip(bounds, bounds[1:], strict=False):
        data = held[begin:end]
        try:
            out.append(inflate.decompress(data) if 0 < zstandard.frame_content_size(data) <= _LONGEST else b"")
        except failed:
            out.append(b"")
    return out


def _read_columns(messages: list[bytes]) -> tuple[np.ndarray, list[pa.Array]]:
    """Which messages are plain (numbers of 63 bits, ASCII texts, known fields of their own type), and the block columns of those: what ``decode_one`` gives, for all at once."""
    sizes = np.fromiter(map(len, messages), np.int64, len(messages))
    data = np.frombuffer(b"".join(messages) + bytes(1), np.uint8)
    plain = sizes > 0

    def varints(at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(value, where it ends, whether it does, in 9 bytes and before ``end``)."""
        value, at, ended, going = np.zeros(len(at), np.int64), at.copy(), np.zeros(len(at), bool), np.arange(len(at))
        for shift in range(0, 63, 7):
            going = going[at[going] < end[going]]
            byte = data[at[going]]
            value[going] |= (byte & 127).astype(np.int64) << shift
            at[going] += 1
            ended[going[byte < 128]] = True
            going = going[byte >= 128]
            if not len(going):
                break
        return value, at, ended

    ends = np.cumsum(sizes)
    tag, at, whole = varints(ends - sizes, ends)
    size, at, more = varints(at, ends)
    plain &= whole & more & ((tag == (1 << 3 | 2)) | (tag == (2 << 3 | 2))) & (size <= ends - at)
    kind, ends = np.where(tag >> 3 == 1, ANNOUNCEMENT, SHARD), at + size
    numbers = {k: np.zeros(len(messages), np.int64) for k in (3, 5)}
    spans = {k: (np.zeros(len(messages), np.int64), np.full(len(messages), -1)) for k in (1, 2, 4)}  # where each begins, and its bytes: -1 without one
    rows = np.flatnonzero(plain)
    while len(rows := rows[at[rows] < ends[rows]]):
        tag, where, whole = varints(at[rows], ends[rows])
        value, where, more = varints(where, ends[rows])
        field, long = tag >> 3, (tag & 7) == 2
        fits = whole & more & np.where(long, value <= ends[rows] - where, ((tag & 7) == 0))
        fits &= ~np.isin(field, [1, 2, 4]) | long
        fits &= ~np.isin(field, [3, 5]) | ~long
        plain[rows[~fits]] = False
        for k, held in numbers.items():
            own = fits & (field == k)
            held[rows[own]] = value[own]
        for k, (begins, lengths) in spans.items():
            own = fits & (field == k)
            begins[rows[own]], lengths[rows[own]] = where[own], value[own]
        at[rows] = where + np.where(long, value, 0)
        rows = rows[fits]
    foreign = np.concatenate([[0], np.cumsum(data > 127)])
    for k in (1, 2):
        begins, lengths = spans[k]
        plain &= foreign[np.where(plain, begins + np.maximum(lengths, 0), 0)] == foreign[np.where(plain, begins, 0)]
    some = np.flatnonzero(plain)

    def taken(k: int) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and bytes of the field in the plain messages."""
        begins, lengths = spans[k][0][some], np.maximum(spans[k][1][some], 0)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        return offsets.astype(np.int32), data[np.repeat(begins - offsets[:-1], lengths) + np.arange(offsets[-1])]

    def texts(k: int) -> pa.Array:
        offsets, held = taken(k)
        return pa.StringArray.from_buffers(len(some), pa.py_buffer(offsets), pa.py_buffer(held))

    offsets, flags = taken(4)
    masks = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flags > 0), mask=pa.array(spans[4][1][some] < 0))
    return plain, [pa.array(numbers[3][some]), pa.array(kind[some], pa.int8()), pa.array(numbers[5][some]), texts(1), texts(2), masks, pa.nulls(len(some), pa.string())]


def _read_rows(payloads: list[bytes | None], kind: str) -> list[pa.Array]:
    """Block columns and errors of payloads, one by one."""
    out: list[list] = [[] for _ in _ARROW]
    for payload in payloads:
        try:
            block, error = decode_one(payload, kind), None
            if block["height"] > 2**63 - 1 or block["shard_id"] > 2**63 - 1:
                block, error = {}, "beyond 63 bits"
        except (DecodeError, UnicodeDecodeError, RecursionError) as e:
            block, error = {}, str(e) or "bad payload"
        for column, name in zip(out, _BLOCK_NAMES, strict=False):
            column.append(block.get(name))
        out[-1].append(error)
    return [pa.array(v, t) for v, t in zip(out, _ARROW, strict=True)]


def _read(payloads: pa.Array, kind: str) -> list[pa.Array]:
    """Block columns and errors of payloads; plain ones of proto_zstd are read by columns."""
    if kind != "proto_zstd" or not len(payloads):
        return _read_rows(payloads.to_pylist(), kind)
    plain, columns = _read_columns(_inflated(payloads))
    if plain.all():
        return columns
    rest = _read_rows(payloads.filter(pa.array(~plain)).to_pylist(), kind)
    place = pa.array(np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])))
    return [pa.concat_arrays([a, b]).take(place) for a, b in zip(columns, rest, strict=True)]


def _written_columns(batch: pa.RecordBatch) -> list[bytes] | None:
    """The proto_zstd payloads of a batch's blocks, as ``encode_one`` writes them; None where they have masks, nulls, negative numbers or long texts."""
    columns = {n: batch.column(n) for n in _BLOCK_NAMES if n in batch.schema.names}
    mask = columns.pop("shard_mask", None)
    if len(columns) < len(_BLOCK_NAMES) - 1 or (mask is not None and mask.null_count < len(mask)) or any(c.null_count for c in columns.values()):
        return None
    height, type_, shard = (columns[n].cast(pa.int64()).to_numpy() for n in ("height", "block_type", "shard_id"))
    length = {n: pc.binary_length(columns[n]).to_numpy() for n in ("hash", "prev_hash")}
    if not len(batch) or min(height.min(), shard.min()) < 0 or max(x.max() for x in length.values()) > _LONGEST_TEXT:
        return None
    cells: list[np.ndarray] = []  # bytes of a row in columns, and which of them it has
    there: list[np.ndarray] = []

    def add(values: np.ndarray, held: np.ndarray) -> None:
        cells.append(values.astype(np.uint8))
        there.append(held)

    def varints(values: np.ndarray, held: np.ndarray) -> None:
        groups = values[:, None] >> 7 * np.arange(max(1, -(-int(values.max()).bit_length() // 7)))
        add((groups & 127) | ((groups > 127) << 7), ((groups > 0) | (np.arange(groups.shape[1]) == 0)) & held[:, None])

    all_ = np.ones(len(batch), bool)
    for field, name in ((1, "hash"), (2, "prev_hash")):
        varints(np.full(len(batch), field << 3 | 2), all_)
        varints(length[name], all_)
        place = np.arange(length[name].max())
        offsets, held = _parts(columns[name])
        held = np.frombuffer(held, np.uint8)
        add(held[np.minimum(offsets[:-1, None] + place, len(held) - 1)], place < length[name][:, None])
    for field, values, held in ((3, height, all_), (5, shard, type_ == SHARD)):
        varints(np.full(len(batch), field << 3), held)
        varints(values, held)
    inner, cells, there = (cells, there), [], []
    varints(np.where(type_ == ANNOUNCEMENT, 1 << 3 | 2, 2 << 3 | 2), all_)
    varints(sum(x.sum(axis=1) for x in inner[1]), all_)
    rows, has = np.hstack(cells + inner[0]), np.hstack(there + inner[1])
    messages, ends = rows[has].tobytes(), np.cumsum(has.sum(axis=1)).tolist()
    compress = _zstd()[2].compress
    return [compress(messages[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def decode(log: DataFrame, kind: str, data: str = "data") -> DataFrame:
    """The rows with block columns in place of the payload, and decode_error; rows are never dropped.

    headers_only reads no payload: the message id alone tells height, type and shard.
    """
    rest = [c for c in log.columns if c != data and c not in _BLOCK_NAMES]
    if kind == "headers_only":
        id_ = parse(first_value(F.col("headers"), MESSAGE_ID))
        most = F.lit(2**63 - 1)
        fits = (id_["height"] <= most) & (id_["shard_id"] <= most)
        nothing = [F.lit("").alias("hash"), F.lit("").alias("prev_hash"), F.lit(None).cast("array<boolean>").alias("shard_mask")]
        error = F.coalesce(id_["error"], F.when(~fits, "beyond 63 bits"))
        return log.select(*rest, F.when(fits, id_["height"]).cast("long").alias("height"), id_["block_type"].cast("byte").alias("block_type"), F.when(fits, id_["shard_id"]).cast("long").alias("shard_id"), *nothing, error.alias("decode_error"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *_read(batch.column(data), kind)], [*rest, *_BLOCK_NAMES, "decode_error"])

    schema = T.StructType([log.schema[c] for c in rest] + BLOCK.fields + [T.StructField("decode_error", T.StringType())])
    return log.select(*rest, data).mapInArrow(run, schema)


def encode(blocks: DataFrame, kind: str, without: tuple[str, ...] = ()) -> DataFrame:
    """The rows with ``data``, the payload of their block columns; ``without`` columns that only the payload is to hold."""
    names, rest = [n for n in _BLOCK_NAMES if n in blocks.columns], [c for c in blocks.columns if c not in without]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sent = _written_columns(batch) if kind == "proto_zstd" else None
            if sent is None:
                rows = pa.RecordBatch.from_arrays([batch.column(n) for n in names], names).to_pylist()
                sent = [encode_one(r, kind) for r in rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(sent, pa.binary())], [*rest, "data"])

    return blocks.mapInArrow(run, T.StructType([*(blocks.schema[c] for c in rest), T.StructField("data", T.BinaryType())]))

"""Field messages: sections, bit packing, and the two ways between messages and rows.

A message is one field in the public WMO FM 92 GRIB form, edition 2: an indicator, sections that begin with their length
and number (1 identification, 3 grid, 4 product, 5 how values are represented, 6 bitmap, 7 values), and an end mark. Values are
read from simple packing, ``(reference + X * 2**binary) / 10**decimal`` with X in any number of bits, and from plain IEEE numbers;
a bitmap leaves undefined ones out. ``refill`` puts codes into the message of another field of the same grid, member and step,
which keeps everything but the product's category and number and the values.

A message of several fields, another edition, another representation or a length that doesn't fit is a ``MessageError``, never a wrong field.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions import constants as C
from ..shipping import ship

#: Fixed values of the form: marks, edition, the number that says that something is missing.
_BEGIN, _END, _EDITION = b"GRIB", b"7777", 2
END = _END
_MISSING, _NO_BITMAP, _BITMAP = 255, 255, 0
_INDICATOR = 16
#: Section numbers, and templates of values (simple packing, IEEE).
IDENTIFICATION, LOCAL, GRID, PRODUCT, REPRESENTATION, BITMAP, VALUES = 1, 2, 3, 4, 5, 6, 7
_SIMPLE, _IEEE = 0, 4
#: Types of surfaces: the ground, and a numbered level of the model.
_GROUND, _LEVEL = 1, 150
_HOURS, _MINUTES = 1, 0
#: Category and number of each parameter's product (discipline 0), and its surface; the output's.
PRODUCTS = {"T": (0, 0, _LEVEL), "P": (3, 0, _LEVEL), "QV": (1, 0, _LEVEL), "HHL": (3, 6, _LEVEL), "TOT_PREC": (1, 52, _GROUND), "T_G": (0, 0, _GROUND)}
OUTPUT_PRODUCT = (1, 19)

#: Values are packed in pieces of so many, a multiple of 8, so that each piece ends with a byte.
_PIECE = 1 << 16


class MessageError(ValueError):
    """A message that isn't what it should be."""


def sections(message: bytes) -> Iterator[tuple[int, int, int]]:
    """(number, begin, end) of the sections behind the indicator; ``begin`` is that of the length."""
    if len(message) < _INDICATOR + len(_END) or message[:4] != _BEGIN:
        raise MessageError("not a message")
    if message[7] != _EDITION:
        raise MessageError(f"edition {message[7]}, expected {_EDITION}")
    (total,) = struct.unpack_from(">Q", message, 8)
    if total != len(message) or message[-4:] != _END:
        raise MessageError(f"{len(message)} bytes, expected {total} with an end mark")
    at, last = _INDICATOR, total - len(_END)
    while at < last:
        if at + 5 > last:
            raise MessageError(f"a section is cut at byte {at}")
        size, number = struct.unpack_from(">IB", message, at)
        if size < 5 or at + size > last:
            raise MessageError(f"section {number} of {size} bytes at byte {at} doesn't fit")
        yield number, at, at + size
        at += size


def _parts(message: bytes) -> dict[int, bytes]:
    """Each section whole; a repeated one means several fields."""
    found: dict[int, bytes] = {}
    for number, begin, end in sections(message):
        if number in found:
            raise MessageError(f"section {number} occurs twice: one field per message is read")
        found[number] = message[begin:end]
    if lost := {IDENTIFICATION, GRID, PRODUCT, REPRESENTATION, BITMAP, VALUES} - found.keys():
        raise MessageError(f"section(s) {sorted(lost)} missing")
    return found


def _signed(value: int, bits: int) -> int:
    """Sign and magnitude, as the form writes negative numbers."""
    low = value & ((1 << bits - 1) - 1)
    return -low if value >> (bits - 1) else low


def _with_sign(value: int, bits: int) -> int:
    return value if value >= 0 else -value | 1 << (bits - 1)


def pack_bits(numbers: np.ndarray, bits: int) -> bytes:
    """Unsigned whole numbers of ``bits`` bits each (0 to 64), one after the other, filled up to a byte."""
    if not 0 <= bits <= 64:
        raise MessageError(f"{bits} bits for a value")
    numbers = np.ascontiguousarray(numbers, np.uint64)
    if bits < 64 and len(numbers) and int(numbers.max()) >> bits:
        raise MessageError(f"{int(numbers.max())} doesn't fit {bits} bits")
    if bits in (8, 16, 32, 64):
        return numbers.astype(f">u{bits // 8}").tobytes()
    pieces = (numbers[k : k + _PIECE].astype(">u8").view(np.uint8) for k in range(0, len(numbers), _PIECE))
    return b"".join(np.packbits(np.unpackbits(p.reshape(-1, 8), axis=1)[:, 64 - bits :]).tobytes() for p in pieces) if bits else b""


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` unsigned whole numbers of ``bits`` bits each."""
    if not 0 <= bits <= 64:
        raise MessageError(f"{bits} bits for a value")
    if len(data) * 8 < n * bits:
        raise MessageError(f"{len(data)} bytes hold less than {n} values of {bits} bits")
    if bits in (8, 16, 32, 64):
        return np.frombuffer(data, f">u{bits // 8}", n).astype(np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(0, n if bits else 0, _PIECE):
        m = min(_PIECE, n - k)
        one = np.unpackbits(np.frombuffer(data, np.uint8)[k * bits // 8 : (k + m) * bits // 8 + 1], count=m * bits).reshape(m, bits)
        wide = np.zeros((m, 64), np.uint8)
        wide[:, 64 - bits :] = one
        out[k : k + m] = np.packbits(wide, axis=1).view(">u8").ravel()
    return out


@dataclass(frozen=True)
class Packing:
    """How values become whole numbers."""

    reference: float
    binary: int
    decimal: int
    bits: int

    @classmethod
    def of(cls, values: np.ndarray, bits: int | None = None, decimal: int = 0) -> Packing:
        """For defined values: in ``bits`` bits, or, where these are not given, without loss for whole numbers."""
        scaled = values * 10.0**decimal
        low, high = (float(scaled.min()), float(scaled.max())) if len(values) else (0.0, 0.0)
        reference = np.float32(low)
        if not np.isfinite(reference):
            raise MessageError(f"{low} is no reference value")
        if float(reference) > low:
            reference = np.nextafter(reference, np.float32(-np.inf))
        span = high - float(reference)
        if bits is None:
            if not (scaled == np.rint(scaled)).all() or float(reference) != low:
                raise MessageError("values are not whole numbers: give a number of bits")
            return cls(low, 0, decimal, int(span).bit_length())
        if span == 0 or bits == 0:
            return cls(float(reference), 0, decimal, 0)
        binary = int(np.ceil(np.log2(span / ((1 << bits) - 1))))
        return cls(float(reference), binary, decimal, bits)

    def pack(self, values: np.ndarray) -> bytes:
        steps = np.rint((values * 10.0**self.decimal - self.reference) * 2.0**-self.binary)
        return pack_bits(np.clip(steps, 0, float((1 << self.bits) - 1)), self.bits)

    def unpack(self, data: bytes, n: int) -> np.ndarray:
        return (self.reference + unpack_bits(data, self.bits, n).astype(np.float64) * 2.0**self.binary) / 10.0**self.decimal


def values_of(message: bytes) -> np.ndarray:
    """The field's values in the order of its points; undefined ones are NaN."""
    part = _parts(message)
    (points,) = struct.unpack_from(">I", part[GRID], 6)
    n, template = struct.unpack_from(">IH", part[REPRESENTATION], 5)
    data, present = part[VALUES][5:], None
    if part[BITMAP][5] == _BITMAP:
        present = unpack_bits(part[BITMAP][6:], 1, points).astype(bool)
        if int(present.sum()) != n:
            raise MessageError(f"{n} values for {int(present.sum())} points in the bitmap")
    elif part[BITMAP][5] != _NO_BITMAP:
        raise MessageError(f"bitmap of kind {part[BITMAP][5]}")
    elif n != points:
        raise MessageError(f"{n} values for {points} points")
    if template == _SIMPLE:
        reference, binary, decimal, bits = struct.unpack_from(">fHHB", part[REPRESENTATION], 11)
        values = Packing(reference, _signed(binary, 16), _signed(decimal, 16), bits).unpack(data, n)
    elif template == _IEEE and part[REPRESENTATION][11] in (1, 2):
        width = 4 * part[REPRESENTATION][11]
        if len(data) < n * width:
            raise MessageError(f"{len(data)} bytes hold less than {n} values of {width} bytes")
        values = np.frombuffer(data, f">f{width}", n).astype(np.float64)
    else:
        raise MessageError(f"values in representation {template}")
    if present is None:
        return values
    out = np.full(points, np.nan)
    out[present] = values
    return out


def shape_of(message: bytes) -> tuple[int, ...]:
    """Rows and columns of a regular grid, or the number of points of any other."""
    grid = _parts(message)[GRID]
    points, _, _, template = struct.unpack_from(">IBBH", grid, 6)
    if template in (0, 1) and len(grid) >= 38:
        nx, ny = struct.unpack_from(">II", grid, 30)
        if nx * ny == points:
            return ny, nx
    return (points,)


def _hours(unit: int, value: int) -> int | None:
    if unit == _HOURS:
        return value
    return value // 60 if unit == _MINUTES and value % 60 == 0 else None


def keys_of(head: bytes) -> dict:
    """What a message says of itself: date, time, step (the end of an interval), level, member, category, number and surface.

    ``head`` may be a message's first bytes: no section behind the product is looked at.
    """
    if head[:4] != _BEGIN or len(head) < _INDICATOR:
        raise MessageError("not a message")
    found, at = {"discipline": head[6]}, _INDICATOR
    while at + 5 <= len(head):
        size, number = struct.unpack_from(">IB", head, at)
        if at + size > len(head):
            break
        if number == IDENTIFICATION:
            year, month, day, hour, minute = struct.unpack_from(">HBBBB", head, at + 12)
            found |= {"run_date": f"{year:04d}{month:02d}{day:02d}", "run_time": f"{hour:02d}{minute:02d}"}
        elif number == PRODUCT:
            (template,) = struct.unpack_from(">H", head, at + 7)
            category, kind = head[at + 9], head[at + 10]
            unit, first, surface, _, level = struct.unpack_from(">BIBBI", head, at + 17)
            step = _hours(unit, first)
            member = head[at + 35] if template in (1, 11) else None
            interval = {8: at + 34, 11: at + 37}.get(template)
            if interval is not None and step is not None:
                unit, length = struct.unpack_from(">BI", head, interval + 14)
                more = _hours(unit, length)
                step = None if more is None else step + more
            return found | {"category": category, "number": kind, "surface": surface, "lev": level if surface == _LEVEL else 0, "step": step, "member": member, "interval": interval is not None}
        at += size
    raise MessageError("no product in the head of the message")


def parameter_of(keys: dict) -> str | None:
    """The name of the parameter that a message's keys stand for."""
    if (keys["category"], keys["number"]) == OUTPUT_PRODUCT:
        return C.OUTPUT_NAME
    return next((name for name, product in PRODUCTS.items() if keys["discipline"] == 0 and product == (keys["category"], keys["number"], keys["surface"])), None)


def _section(number: int, body: bytes) -> bytes:
    return struct.pack(">IB", len(body) + 5, number) + body


def _whole(discipline: int, parts: list[bytes]) -> bytes:
    body = b"".join(parts)
    return _BEGIN + b"\xff\xff" + bytes([discipline, _EDITION]) + struct.pack(">Q", _INDICATOR + len(body) + len(_END)) + body + _END


def _exact(n: int) -> bytes:
    """Representation of ``n`` defined values as they are in double precision."""
    return struct.pack(">IHB", n, _IEEE, 2)


def _represented(values: np.ndarray, bits: int | None, exact: bool) -> list[bytes]:
    """Representation, bitmap and values."""
    present = np.isfinite(values)
    kept = values[present] if not present.all() else values
    bitmap = bytes([_NO_BITMAP]) if present.all() else bytes([_BITMAP]) + pack_bits(present, 1)
    if exact:
        kind, data = _exact(len(kept)), kept.astype(">f8").tobytes()
    else:
        p = Packing.of(kept, bits)
        kind, data = struct.pack(">IHfHHBB", len(kept), _SIMPLE, p.reference, _with_sign(p.binary, 16), _with_sign(p.decimal, 16), p.bits, 0), p.pack(kept)
    return [_section(REPRESENTATION, kind), _section(BITMAP, bitmap), _section(VALUES, data)]


def _described(param: str, points: int, run_date: str, run_time: str, member: str, step: int, lev: int, shape: tuple[int, ...] | None) -> list[bytes]:
    """Identification, grid and product of a field."""
    category, number, surface = (*OUTPUT_PRODUCT, _GROUND) if param == C.OUTPUT_NAME else PRODUCTS[param]
    at = datetime.strptime(run_date + run_time, "%Y%m%d%H%M")
    when = struct.pack(">HBBBBB", at.year, at.month, at.day, at.hour, at.minute, at.second)
    identification = struct.pack(">HHBBB", 0, 0, 28, 0, 1) + when + bytes([0, 4])
    if shape is None or len(shape) == 1:
        # points of an unstructured grid that is named elsewhere
        grid = struct.pack(">BIBBH", 0, points, 0, 0, 101) + bytes([6, 0, 0, 0, 1, 1]) + bytes(16)
    else:
        earth = bytes([6]) + bytes([_MISSING, *[_MISSING] * 4]) * 3
        corner = struct.pack(">IIiiBiiIIB", 0, _MISSING, 0, 0, 48, 0, 0, 1, 1, 64)
        grid = struct.pack(">BIBBH", 0, points, 0, 0, 0) + earth + struct.pack(">II", shape[1], shape[0]) + corner
    if int(np.prod(shape or (points,))) != points:
        raise MessageError(f"{points} values don't fill the shape {shape}")
    total = param == "TOT_PREC"
    product = struct.pack(">HHBBBBBHBBIBBIBBI", 0, 11 if total else 1, category, number, 2, 0, 0, 0, 0, _HOURS, 0 if total else step, surface, 0, lev, _MISSING, _MISSING, 0xFFFFFFFF)
    product += bytes([0 if int(member) == 0 else 3, int(member), 0])
    if total:
        # accumulated from the beginning of the run: one range of so many hours
        end = struct.pack(">HBBBBB", at.year, at.month, at.day, at.hour, at.minute, at.second)
        product += end + struct.pack(">BIBBBIBI", 1, 0, 1, 2, _HOURS, step, _MISSING, 0)
    return [_section(IDENTIFICATION, identification), _section(GRID, grid), _section(PRODUCT, product)]


def field_message(param: str, values: np.ndarray, *, run_date: str, run_time: str, member: str, step: int, lev: int = 0, shape: tuple[int, ...] | None = None, bits: int | None = None) -> bytes:
    """A new message of one field: with ``bits`` packed, else as it is in double precision. ``shape`` gives rows and columns."""
    values = np.asarray(values, np.float64).ravel()
    return _whole(0, [*_described(param, len(values), run_date, run_time, member, step, lev, shape), *_represented(values, bits, bits is None)])


def field_begin(param: str, points: int, defined: int, bitmap: bytes | None, *, run_date: str, run_time: str, member: str, step: int, lev: int = 0) -> bytes:
    """A message up to its first value, for values that follow in parts (big-endian double precision) before ``END``.

    ``bitmap`` (a bit for each point, of which ``defined`` are set) is needed where points are undefined.
    """
    mask = bytes([_NO_BITMAP]) if bitmap is None else bytes([_BITMAP]) + bitmap
    parts = [*_described(param, points, run_date, run_time, member, step, lev, None), _section(REPRESENTATION, _exact(defined)), _section(BITMAP, mask)]
    size = 8 * defined
    if size + 5 >= 1 << 32:
        raise MessageError(f"{defined} values don't fit a section")
    before = b"".join(parts) + struct.pack(">IB", size + 5, VALUES)
    return _BEGIN + b"\xff\xff" + bytes([0, _EDITION]) + struct.pack(">Q", _INDICATOR + len(before) + size + len(END)) + before


def refill(message: bytes, codes: np.ndarray) -> bytes:
    """The message of another field with codes in place of its values, and the output's category and number."""
    part = _parts(message)
    (points,) = struct.unpack_from(">I", part[GRID], 6)
    codes = np.asarray(codes)
    if codes.size != points:
        raise MessageError(f"{codes.size} codes don't fill the shape {shape_of(message)}")
    product = bytearray(part[PRODUCT])
    product[9:11] = bytes(OUTPUT_PRODUCT)
    kept = [part[k] for k in (IDENTIFICATION, LOCAL, GRID) if k in part]
    return _whole(0, [*kept, bytes(product), *_represented(codes.ravel().astype(np.float64), None, False)])


def coded_message(head: bytes, codes: np.ndarray) -> bytes:
    """What ``refill`` makes, from a message's first sections (up to the product) and whole numbers of any type, packed piece by piece."""
    part, at = {}, _INDICATOR
    while PRODUCT not in part:
        if at + 5 > len(head):
            raise MessageError("no product in the head of the message")
        size, number = struct.unpack_from(">IB", head, at)
        if number in part or size < 5 or at + size > len(head):
            raise MessageError(f"section {number} of {size} bytes at byte {at} doesn't fit")
        part[number] = head[at : at + size]
        at += size
    if lost := {IDENTIFICATION, GRID} - part.keys():
        raise MessageError(f"section(s) {sorted(lost)} missing")
    (points,) = struct.unpack_from(">I", part[GRID], 6)
    if len(codes) != points:
        raise MessageError(f"{len(codes)} codes don't fill the shape ({points},)")
    low, high = (int(codes.min()), int(codes.max())) if len(codes) else (0, 0)
    p = Packing(low, 0, 0, (high - low).bit_length())
    if float(np.float32(low)) != low:
        raise MessageError(f"{low} is no reference value")
    product = bytearray(part[PRODUCT])
    product[9:11] = bytes(OUTPUT_PRODUCT)
    kind = struct.pack(">IHfHHBB", len(codes), _SIMPLE, p.reference, 0, 0, p.bits, 0)
    data = b"".join(pack_bits((codes[k : k + _PIECE].astype(np.int64) - low).astype(np.uint64), p.bits) for k in range(0, len(codes), _PIECE))
    kept = [part[k] for k in (IDENTIFICATION, LOCAL, GRID) if k in part]
    return _whole(0, [*kept, bytes(product), _section(REPRESENTATION, kind), _section(BITMAP, bytes([_NO_BITMAP])), _section(VALUES, data)])


class LongMessage:
    """A message in a file or in memory, read section by section, its values part by part. ``read`` (bytes, at) gives bytes of the message."""

    def __init__(self, read: Callable[[int, int], bytes], total: int):
        self.read, self.at = read, {}
        begin = read(_INDICATOR, 0)
        if len(begin) < _INDICATOR or total < _INDICATOR + len(_END) or begin[:4] != _BEGIN:
            raise MessageError("not a message")
        if begin[7] != _EDITION:
            raise MessageError(f"edition {begin[7]}, expected {_EDITION}")
        if struct.unpack_from(">Q", begin, 8) != (total,) or read(len(_END), total - len(_END)) != _END:
            raise MessageError(f"{total} bytes, expected {struct.unpack_from('>Q', begin, 8)[0]} with an end mark")
        at, last = _INDICATOR, total - len(_END)
        while at < last:
            if at + 5 > last:
                raise MessageError(f"a section is cut at byte {at}")
            size, number = struct.unpack(">IB", read(5, at))
            if size < 5 or at + size > last:
                raise MessageError(f"section {number} of {size} bytes at byte {at} doesn't fit")
            if number in self.at:
                raise MessageError(f"section {number} occurs twice: one field per message is read")
            self.at[number] = (at, size)
            at += size
        if lost := {IDENTIFICATION, GRID, PRODUCT, REPRESENTATION, BITMAP, VALUES} - self.at.keys():
            raise MessageError(f"section(s) {sorted(lost)} missing")

    def _section(self, number: int) -> bytes:
        at, size = self.at[number]
        return self.read(size, at)

    def head(self) -> bytes:
        """All up to the end of the product."""
        return self.read(sum(self.at[PRODUCT]), 0)

    def points(self) -> int:
        return struct.unpack(">I", self.read(4, self.at[GRID][0] + 6))[0]

    def values(self, size: int, begin: int = 0, end: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(first point, values) of parts of ``size`` points, a multiple of 8, from part ``begin`` to before ``end``; undefined values are NaN."""
        points, kind = self.points(), self._section(REPRESENTATION)
        n, template = struct.unpack_from(">IH", kind, 5)
        at, room = self.at[VALUES][0] + 5, self.at[VALUES][1] - 5
        (bitmap,), present = self.read(1, self.at[BITMAP][0] + 5), None
        if bitmap == _BITMAP:
            present = np.frombuffer(self._section(BITMAP), np.uint8, offset=6)
            if len(present) * 8 < points:
                raise MessageError(f"{len(present)} bytes hold less than {points} values of 1 bits")
            found = sum(int(np.unpackbits(present[k : k + _PIECE // 8], count=min(_PIECE, points - 8 * k)).sum()) for k in range(0, -(-points // 8), _PIECE // 8))
            if found != n:
                raise MessageError(f"{n} values for {found} points in the bitmap")
        elif bitmap != _NO_BITMAP:
            raise MessageError(f"bitmap of kind {bitmap}")
        elif n != points:
            raise MessageError(f"{n} values for {points} points")
        if template == _SIMPLE:
            reference, binary, decimal, bits = struct.unpack_from(">fHHB", kind, 11)
            packing = Packing(reference, _signed(binary, 16), _signed(decimal, 16), bits)
        elif template == _IEEE and kind[11] in (1, 2):
            packing, bits = None, 32 * kind[11]
        else:
            raise MessageError(f"values in representation {template}")
        if room * 8 < n * bits:
            raise MessageError(f"{room} bytes hold less than {n} values of {bits} bits")
        done = 0  # values before this part
        for k in range(0, points, size):
            m = min(size, points - k)
            mask = None if present is None else np.unpackbits(present[k // 8 : (k + m + 7) // 8], count=m).astype(bool)
            some = m if mask is None else int(mask.sum())
            if k // size >= begin and (end is None or k // size < end):
                skip = done % 8  # so that the bytes read begin with a value
                first, last = (done - skip) * bits // 8, ((done + some) * bits + 7) // 8
                data = self.read(last - first, at + first) if last > first else b""
                values = np.frombuffer(data, f">f{bits // 8}", skip + some).astype(np.float64) if packing is None else packing.unpack(data, skip + some)
                if mask is None:
                    yield k, values[skip:]
                else:
                    out = np.full(m, np.nan)
                    out[mask] = values[skip:]
                    yield k, out
            done += some


def encode_fields(fields: DataFrame, *, bits: int | None = None, shape: tuple[int, ...] | None = None) -> DataFrame:
    """``fields`` of the store with a column ``message`` in place of ``values``."""
    ship(fields.sparkSession)
    names = {i: n for n, i in C.PARAMS.items()}
    keys = ["param_id", "run_date", "run_time", "member", "step", "lev"]
    rest = [c for c in fields.columns if c != "values"]

    def encoded(batches):
        for b in batches:
            at = [b.column(b.schema.get_field_index(k)).to_pylist() for k in keys]
            values = b.column(b.schema.get_field_index("values"))
            cut, flat = values.offsets.to_numpy(), values.values.to_numpy(zero_copy_only=False)
            made = [field_message(names[p], flat[cut[k] : cut[k + 1]], run_date=d, run_time=t, member=m, step=s, lev=lev, shape=shape, bits=bits) for k, (p, d, t, m, s, lev) in enumerate(zip(*at, strict=True))]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in rest], pa.array(made, pa.binary())], [*rest, "message"])

    kinds = ", ".join(f"{c} {fields.schema[c].dataType.simpleString()}" for c in rest)
    return fields.mapInArrow(encoded, f"{kinds}, message binary")


def decode_fields(messages: DataFrame) -> DataFrame:
    """Rows with ``message`` and any other columns: ``values`` (array<double>) in place of the message."""
    ship(messages.sparkSession)
    rest = [c for c in messages.columns if c != "message"]

    def decoded(batches):
        for b in batches:
            values = pa.array([values_of(m) for m in b.column(b.schema.get_field_index("message")).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in rest], values], [*rest, "values"])

    kinds = ", ".join(f"{c} {messages.schema[c].dataType.simpleString()}" for c in rest)
    return messages.mapInArrow(decoded, f"{kinds}, values array<double>")

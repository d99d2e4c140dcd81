"""Single-file NIfTI-1 and NIfTI-2 volumes (``.nii``, ``.nii.gz``): the
per-file helper run inside Spark tasks by the tensor job.  Header fields
used: dim, datatype, vox_offset, scl_slope, scl_inter; voxels are stored
with the first axis fastest (Fortran order)."""

from __future__ import annotations

import gzip
import io
import math
import struct
from typing import BinaryIO

import numpy as np

# NIfTI datatype codes (same in versions 1 and 2) -> numpy types.
DTYPES = {2: np.uint8, 4: np.int16, 8: np.int32, 16: np.float32, 64: np.float64,
          256: np.int8, 512: np.uint16, 768: np.uint32, 1024: np.int64, 1280: np.uint64}
CODES = {np.dtype(v): k for k, v in DTYPES.items()}
HEADER_SIZE = 348
HEADER2_SIZE = 540


def _maybe_gunzip(data: bytes) -> bytes:
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def _header(raw: bytes) -> tuple[str, tuple[int, ...], int, int, float, float]:
    """(byte order, shape, datatype code, voxel offset, slope, intercept)."""
    for endian in ("<", ">"):
        size = struct.unpack(endian + "i", raw[:4])[0]
        if size == HEADER_SIZE:
            dim = struct.unpack(endian + "8h", raw[40:56])
            code = struct.unpack(endian + "h", raw[70:72])[0]
            offset = int(struct.unpack(endian + "f", raw[108:112])[0])
            slope, inter = struct.unpack(endian + "2f", raw[112:120])
            break
        if size == HEADER2_SIZE:
            if len(raw) < HEADER2_SIZE:
                raise ValueError("file too short for a NIfTI-2 header")
            code = struct.unpack(endian + "h", raw[12:14])[0]
            dim = struct.unpack(endian + "8q", raw[16:80])
            offset = struct.unpack(endian + "q", raw[168:176])[0]
            slope, inter = struct.unpack(endian + "2d", raw[176:192])
            break
    else:
        raise ValueError("not a NIfTI file (sizeof_hdr is neither 348 nor 540)")
    ndim = dim[0]
    if not 1 <= ndim <= 7:
        raise ValueError(f"bad dim[0]={ndim}")
    return endian, tuple(int(d) for d in dim[1:1 + ndim]), code, offset, slope, inter


def decode(data: bytes) -> np.ndarray:
    """Volume as float64 with intensity scaling applied (slope 0 or not
    finite means unscaled)."""
    raw = _maybe_gunzip(data)
    if len(raw) < HEADER_SIZE:
        raise ValueError("file too short for a NIfTI header")
    endian, shape, code, offset, slope, inter = _header(raw)
    if code not in DTYPES:
        raise ValueError(f"unsupported datatype code {code}")
    dtype = np.dtype(DTYPES[code]).newbyteorder(endian)
    count = int(np.prod(shape))
    vox = np.frombuffer(raw, dtype=dtype, count=count, offset=offset)
    vol = vox.reshape(shape, order="F").astype(np.float64)
    if np.isfinite(slope) and slope != 0:
        inter = inter if np.isfinite(inter) else 0.0
        vol = vol * slope + inter
    return vol


def encode(volume: np.ndarray, slope: float = 1.0, inter: float = 0.0,
           big_endian: bool = False, compress: bool = True, version: int = 1) -> bytes:
    """A minimal single-file NIfTI image, version 1 or 2 (used by tests and
    the sample files written from table rows)."""
    vol = np.asarray(volume)
    endian = ">" if big_endian else "<"
    code = CODES[vol.dtype.newbyteorder("=")] if vol.dtype.byteorder not in "=|" else CODES[vol.dtype]
    if version == 2:
        hdr = bytearray(HEADER2_SIZE)
        struct.pack_into(endian + "i", hdr, 0, HEADER2_SIZE)
        hdr[4:12] = b"n+2\x00\r\n\x1a\n"
        struct.pack_into(endian + "h", hdr, 12, code)
        struct.pack_into(endian + "h", hdr, 14, vol.dtype.itemsize * 8)
        struct.pack_into(endian + "8q", hdr, 16, vol.ndim, *vol.shape, *([1] * (7 - vol.ndim)))
        struct.pack_into(endian + "8d", hdr, 104, *([1.0] * 8))
        struct.pack_into(endian + "q", hdr, 168, 544)
        struct.pack_into(endian + "2d", hdr, 176, slope, inter)
        body = vol.astype(vol.dtype.newbyteorder(endian)).tobytes(order="F")
        out = bytes(hdr) + b"\x00" * 4 + body
        return gzip.compress(out, compresslevel=1) if compress else out
    hdr = bytearray(HEADER_SIZE)
    struct.pack_into(endian + "i", hdr, 0, HEADER_SIZE)
    dims = [vol.ndim, *vol.shape] + [1] * (7 - vol.ndim)
    struct.pack_into(endian + "8h", hdr, 40, *dims)
    struct.pack_into(endian + "h", hdr, 70, code)
    struct.pack_into(endian + "h", hdr, 72, vol.dtype.itemsize * 8)
    struct.pack_into(endian + "8f", hdr, 76, 1.0, *([1.0] * 7))
    struct.pack_into(endian + "f", hdr, 108, 352.0)
    struct.pack_into(endian + "2f", hdr, 112, slope, inter)
    hdr[344:348] = b"n+1\x00"
    body = vol.astype(vol.dtype.newbyteorder(endian)).tobytes(order="F")
    out = bytes(hdr) + b"\x00" * 4 + body
    return gzip.compress(out, compresslevel=1) if compress else out


def to_tensor(volume: np.ndarray) -> np.ndarray:
    """T1 + T2: add a channel axis, float32 / 255 (no clipping), flatten in
    C order (last axis fastest)."""
    v = np.expand_dims(volume, axis=-1).astype(np.float32) / np.float32(255.0)
    return v.reshape(-1)


#: Bytes of a file inflated at once.
BLOCK_BYTES = 4 << 20


def _inflated(stream: BinaryIO) -> BinaryIO:
    """The stream's contents, inflated as they are read where they are gzip."""
    head = io.BufferedReader(stream, 1 << 16)
    return gzip.GzipFile(fileobj=head) if head.peek(2)[:2] == b"\x1f\x8b" else head


def _start(stream: BinaryIO) -> tuple[BinaryIO, tuple]:
    """The inflated stream, at its start, and the header."""
    data = io.BufferedReader(_inflated(stream), 1 << 16)
    raw = data.peek(HEADER2_SIZE)[:HEADER2_SIZE]
    if len(raw) < HEADER_SIZE:
        raise ValueError("file too short for a NIfTI header")
    header = _header(raw)
    if header[2] not in DTYPES:
        raise ValueError(f"unsupported datatype code {header[2]}")
    return data, header


def slab_width(shape: tuple[int, ...], buffer_bytes: int) -> int:
    """Planes of the first axis that a slab of float32 values has, one at least."""
    return max(1, min(shape[0], buffer_bytes // max(4 * math.prod(shape[1:]), 1)))


def read_shape(stream: BinaryIO) -> tuple[int, ...]:
    return _start(stream)[1][1]


def read_slab(stream: BinaryIO, first: int, width: int) -> np.ndarray:
    """Planes ``first`` to ``first + width`` of the first axis as tensor values (as
    ``to_tensor`` of the whole volume has them, in C order).  The file is inflated block
    by block; held are one block and the slab, twice while it is turned round."""
    data, (endian, shape, code, offset, slope, inter) = _start(stream)
    dtype = np.dtype(DTYPES[code]).newbyteorder(endian)
    _skip(data, offset)
    rows, width = math.prod(shape[1:]), min(width, shape[0] - first)
    out = np.empty((rows, width), np.float32)
    step = max(1, BLOCK_BYTES // max(shape[0] * dtype.itemsize, 1))
    for at in range(0, rows, step):
        n = min(step, rows - at)
        raw = data.read(n * shape[0] * dtype.itemsize)
        if len(raw) < n * shape[0] * dtype.itemsize:
            raise ValueError("file ends before its last voxel")
        part = np.frombuffer(raw, dtype).reshape(n, shape[0])[:, first:first + width].astype(np.float64)
        if np.isfinite(slope) and slope != 0:
            part = part * slope + (inter if np.isfinite(inter) else 0.0)
        out[at:at + n] = part.astype(np.float32) / np.float32(255.0)
    # rows come with the second axis fastest; C order has the last one fastest
    turned = out.reshape(*shape[:0:-1], width)
    return turned.transpose(*reversed(range(turned.ndim))).reshape(-1)


def _skip(data: BinaryIO, n: int) -> None:
    while n > 0:
        got = len(data.read(min(n, BLOCK_BYTES)))
        if not got:
            raise ValueError("file ends before its first voxel")
        n -= got

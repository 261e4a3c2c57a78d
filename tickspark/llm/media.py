"""Media columns: content-addressed payloads in tar shards.

A text becomes a payload (its UTF-8 bytes, filled with spaces to rows of 192) and the payload a grey PNG of 8-bit samples,
192 wide. Each distinct payload is stored under its SHA-256 in a tar shard of the shared folder; a row holds digest,
shard, offset and length. The first 33 bytes of a stored image tell its size and kind, so a range read of the header fills
the metadata columns, and the image is only read where its samples are needed.

Payloads are encoded and stored where they are read, each once a task, and never shuffled: of copies that several tasks have
stored, the index keeps the first place, so however many copies a text has, none gathers in one task. A shard is written
under a passing name and then moved to its own; a task that runs again writes the same bytes.

Defined cases: a null text is empty; an empty text is one row of spaces; equal texts share one stored image; rows and ids
may repeat; other columns of the input are not read; an empty table makes no shard.
"""

from __future__ import annotations

import hashlib
import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import bound_batches, cut, file_system, partitions, scratch

WIDTH = 192
SHARD_BYTES = 128 << 20
SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER = 33
BLOCK = 512
#: Samples that are looked at together.
PIECE = 192 << 12


def padding(n: Column) -> Column:
    """Spaces that fill n bytes to a positive multiple of the width."""
    return F.when(n == 0, WIDTH).otherwise(F.pmod(-n, F.lit(WIDTH)))


def payload(text: bytes) -> bytes:
    return text + b" " * (-len(text) % WIDTH if text else WIDTH)


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(data: bytes) -> bytes:
    """A grey PNG with a sample a byte."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)  # filter type 0 before each row
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return b"".join((SIGNATURE, chunk(b"IHDR", head), chunk(b"IDAT", zlib.compress(lines, 6)), chunk(b"IEND", b"")))


def read_header(head: bytes) -> tuple[int, int, int, int]:
    """width, height, bit depth, colour type."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR" or struct.unpack(">I", head[29:33])[0] != zlib.crc32(head[12:29]):
        raise ValueError("not an image of this store")
    return struct.unpack(">IIBB", head[16:26])


def decode(image: bytes) -> bytes:
    width, height, _, _ = read_header(image[:HEADER])
    n = struct.unpack(">I", image[HEADER : HEADER + 4])[0]
    body = image[HEADER + 4 : HEADER + 8 + n]
    if body[:4] != b"IDAT" or struct.unpack(">I", image[HEADER + 8 + n : HEADER + 12 + n])[0] != zlib.crc32(body):
        raise ValueError("damaged image")
    return np.frombuffer(zlib.decompress(body[4:]), np.uint8).reshape(height, width + 1)[:, 1:].tobytes()


def tar_header(name: str, size: int) -> bytes:
    """A USTAR header with no times or owners, so equal contents make equal shards."""
    h = bytearray(struct.pack("100s8s8s8s12s12s8s1s100s6s2s", name.encode(), b"0000644\0", b"0000000\0", b"0000000\0", b"%011o\0" % size, b"00000000000\0", b" " * 8, b"0", b"", b"ustar\0", b"00").ljust(BLOCK, b"\0"))
    h[148:156] = b"%06o\0 " % sum(h)
    return bytes(h)


def feature(data: bytes) -> str:
    """Mean and spread of the samples, share of steps between neighbours, and an 8 x 8 mean hash.

    Everything follows from counts and sums over pieces of the image, so no copy of the whole is made."""
    x = np.frombuffer(data, np.uint8)
    counts, steps = np.zeros(256, np.int64), 0
    for a in range(0, len(x), PIECE):
        counts += np.bincount(x[a : a + PIECE], minlength=256)
        piece = x[a : a + PIECE + 1]  # with the first sample of the next one
        steps += int(np.count_nonzero(piece[1:] != piece[:-1]))
    values = np.arange(256)
    mean = int((counts * values).sum()) / len(x)
    spread = math.sqrt(float((counts * (values - mean) ** 2).sum()) / len(x))
    image = x.reshape(-1, WIDTH)
    height, cells = len(image), []
    for k in range(8):
        a, b = min(k * height // 8, height - 1), (k + 1) * height // 8
        band = image[a : max(b, a + 1)]
        columns = np.zeros(WIDTH, np.int64)
        for r in range(0, len(band), PIECE // WIDTH):
            columns += band[r : r + PIECE // WIDTH].sum(axis=0, dtype=np.int64)
        cells += [int(c) / (len(band) * (WIDTH // 8)) for c in columns.reshape(8, -1).sum(axis=1)]
    level = sum(cells) / len(cells)
    bits = int("".join("01"[c > level] for c in cells), 2)
    return f"{mean:.4f}:{spread:.4f}:{steps / (len(x) - 1):.4f}:{bits:016x}"


def store(docs: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Stores every distinct text; returns digest, shard, offset, length, one row each."""

    def to_shards(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        attempt = TaskContext.get().taskAttemptId()
        number, made, out, at, temp, name, rows = TaskContext.get().partitionId(), 0, None, 0, "", "", []
        seen: set[bytes] = set()

        def close():
            out.write(b"\0" * (2 * BLOCK))
            out.close()
            system.move(temp, f"{root}/{name}")

        for part in parts:
            for text in part["text"]:
                data = payload(text)
                digest = hashlib.sha256(data)
                if digest.digest() in seen:
                    continue
                seen.add(digest.digest())
                image = encode(data)
                if out is None or at >= shard_bytes:
                    if out is not None:
                        close()
                    # a repeated task makes shards of its own; the index has the rows of the one that ended well
                    name, temp, at, made = f"{number:06d}-{made:04d}-{attempt}.tar", f"{root}/.{uuid.uuid4().hex}", 0, made + 1
                    out = system.open_output_stream(temp)
                out.write(tar_header(f"{digest.hexdigest()}.png", len(image)))
                out.write(image)
                out.write(b"\0" * (-len(image) % BLOCK))
                rows.append((digest.hexdigest(), name, at + BLOCK, len(image)))
                at += BLOCK + len(image) + -len(image) % BLOCK
        if out is not None:
            close()
        yield pd.DataFrame(rows, columns=["digest", "shard", "offset", "length"])

    spark = docs.sparkSession
    bound_batches(spark)
    system, root = file_system(folder)
    system.create_dir(root)
    stored = docs.select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).mapInPandas(to_shards, "digest string, shard string, offset long, length long")
    stored = cut(stored, "media-stored")
    return stored.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("_at")).select("digest", "_at.*")


def read(index: DataFrame, folder: str, samples: bool = True) -> DataFrame:
    """``index`` with width, height, bit_depth from the headers; with ``samples`` also what the whole images hold."""
    columns = ["digest", "shard", "offset", "length", "width", "height", "bit_depth"]
    more = ["payload_bytes", "payload_sha256", "tail_crc32", "media_sha256", "feature"] if samples else []

    def fill(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = file_system(folder)
        name, file = None, None
        for part in parts:
            out = []
            for key, shard, offset, length in zip(part["digest"], part["shard"], part["offset"], part["length"], strict=True):
                if shard != name:
                    if file is not None:
                        file.close()
                    name, file = shard, system.open_input_file(f"{root}/{shard}")
                file.seek(offset)
                width, height, depth, _ = read_header(file.read(HEADER))
                row = (key, shard, offset, length, width, height, depth)
                if samples:
                    file.seek(offset)
                    image = file.read(length)
                    data = decode(image)
                    row += (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), hashlib.sha256(image).hexdigest(), feature(data))
                out.append(row)
            yield pd.DataFrame(out, columns=columns + more)
        if file is not None:
            file.close()

    schema = "digest string, shard string, offset long, length long, width long, height long, bit_depth int"
    schema += ", payload_bytes long, payload_sha256 string, tail_crc32 long, media_sha256 string, feature string" if samples else ""
    dealt = index.repartitionByRange(partitions(index.sparkSession), "shard", "offset").sortWithinPartitions("shard", "offset")
    return dealt.mapInPandas(fill, schema)


def media_columns(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """doc_id, n_bytes, digest, shard, offset, length, and the columns of ``read``, for every row of ``docs``."""
    folder = folder or scratch(docs.sparkSession, "media")
    stored = cut(read(store(docs, folder), folder), "media-read")
    text = F.coalesce(F.col("text"), F.lit(""))
    n = F.octet_length(text)
    rows = docs.select("doc_id", n.cast("long").alias("n_bytes"), F.sha2(F.concat(text, F.repeat(F.lit(" "), padding(n).cast("int"))).cast("binary"), 256).alias("digest"))
    return rows.join(stored, "digest")

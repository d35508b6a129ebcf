"""Media columns: payloads as image files, stored as content-defined chunks.

A payload is stored losslessly as the samples of a binary 8-bit greymap (PGM), WIDTH samples a line. The file is cut where a
rolling gear hash of the last 32 bytes has its CUT_BITS top bits 0, within MIN_CHUNK to MAX_CHUNK bytes; equal passages of files so
become equal chunks. Chunks are kept once for each digest, zstd-compressed; a file is the ordered list of its chunks' digests.
Reading joins the lists with the chunk store, puts the files together in order, and verifies every chunk and every file by digest.

Both are written tables. A chunk that one place of one file has stays in the row of its list, so most files are read where they stand, without
a shuffle; chunks that may come more often, by a map of bits of fixed size, are deduplicated in a pool by digest and joined. A chunk that
many files share is dealt to several lanes of that join, a copy in each.

Edge cases: a null text counts as empty and has one line of padding; equal texts and repeated rows share one file; a text of any length is
stored whole; a missing or damaged chunk raises; an empty table gives an empty result; other columns than doc_id and text aren't read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import textops
from quern.llm.storage import durable, table

WIDTH = 192
MIN_CHUNK, MAX_CHUNK, CUT_BITS = 2048, 65536, 13
LEVEL = 9
#: Files to a lane of the join, for chunks that more files share.
LANE = 500
_GEAR = np.random.Generator(np.random.PCG64(8)).integers(0, 2**32, 256, dtype=np.uint32)


def payload(text: str) -> bytes:
    """UTF-8 with spaces up to a positive multiple of WIDTH."""
    raw = text.encode()
    return raw + b" " * (max(WIDTH, -(-len(raw) // WIDTH) * WIDTH) - len(raw))


def encode(samples: bytes) -> bytes:
    """The PGM file."""
    return b"P5\n%d %d\n255\n" % (WIDTH, len(samples) // WIDTH) + samples


def decode(file: bytes) -> bytes:
    """The samples of a PGM file."""
    magic, shape, top, samples = file.split(b"\n", 3)
    width, height = map(int, shape.split())
    if magic != b"P5" or top != b"255" or width * height != len(samples):
        raise ValueError("not a greymap as stored here")
    return samples


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: the sum of the last 32 bytes' random values, each shifted left by its age."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        if len(h) > step:
            h[step:] += h[:-step] << np.uint32(step)
    return h


def cuts(file: bytes) -> list[int]:
    """Ends of the chunks."""
    data = np.frombuffer(file, dtype=np.uint8)
    spots = (np.flatnonzero(gear(data) >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist() if len(file) > MIN_CHUNK else []
    out, start = [], 0
    for spot in [*spots, len(file)]:
        while spot - start > MAX_CHUNK:
            start += MAX_CHUNK
            out.append(start)
        if spot - start >= MIN_CHUNK and spot < len(file):
            out.append(spot)
            start = spot
    if start < len(file):
        out.append(len(file))
    return out


def chunks(file: bytes) -> list[bytes]:
    ends = cuts(file)
    return [file[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def features(samples: bytes) -> str:
    """Of the greymap: lines, mean, deviation, entropy of the samples, and the mean step along a line."""
    v = np.frombuffer(samples, dtype=np.uint8)
    share = np.bincount(v, minlength=256) / len(v)
    share = share[share > 0]
    step = np.abs(np.diff(v.reshape(-1, WIDTH).astype(np.int16), axis=1)).mean()
    return f"lines={len(v) // WIDTH};mean={v.mean():.4f};dev={v.std():.4f};entropy={-(share * np.log2(share)).sum():.4f};step={step:.4f}"


def _digests(batches):
    """The digest of every chunk of every text."""
    for batch in batches:
        for part in textops.pieces(batch):
            keys = [digest(c) for text in textops.texts_of(part.column("text")).to_pylist() for c in chunks(encode(payload(text)))]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], ["digest"])


def _place(key: bytes) -> int:
    """A digest's bit in the map of repeated ones."""
    return int.from_bytes(key[:3], "big")


def repeated(docs: DataFrame) -> np.ndarray:
    """A map of 2^24 bits (2 MB, whatever the number of chunks) that has the bits of all digests that come more than once.

    A digest whose bit isn't set is unique for certain; others may be unique too, and only cost more.
    """
    counted = docs.select("text").mapInArrow(_digests, "digest binary").groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    place = F.conv(F.hex(F.substring("digest", 1, 3)), 16, 10).cast("long")
    rows = counted.select(place.alias("p")).groupBy(F.expr("p div 32768").alias("k")).agg(F.bitmap_construct_agg(F.expr("p % 32768")).alias("bits")).collect()
    out = np.zeros(1 << 24 >> 3, dtype=np.uint8)
    for r in rows:  # 512 rows at most
        out[r["k"] * 4096 : (r["k"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return np.unpackbits(out, bitorder="little").view(bool)


def _pack():
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=True)


def _file_name(file: bytes, n: int) -> bytes:
    # the unpadded size is part of a file's name: texts that differ in closing spaces only may have equal files
    return hashlib.sha256(file).digest() + n.to_bytes(8, "big")


def _lists(bits: bytes):
    """A row for each text: its file's name, sizes, the digests of its chunks, and the chunks that no other place has, compressed."""
    names = ["doc_id", "n_bytes", "file", "chunks", "own"]
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.binary())]

    def run(batches):
        shared, pack = np.unpackbits(np.frombuffer(bits, dtype=np.uint8)).view(bool), _pack()
        for batch in batches:
            for part in textops.pieces(batch):
                rows = []
                for text in textops.texts_of(part.column("text")).to_pylist():
                    file = encode(payload(text))
                    cut = chunks(file)
                    keys = [digest(c) for c in cut]
                    n = len(text.encode())
                    rows.append((n, _file_name(file, n), keys, [None if shared[_place(k)] else pack.compress(c) for k, c in zip(keys, cut, strict=True)]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))], names)

    return run


def _shared(bits: bytes):
    """Each chunk that other places may have, once for each task, compressed."""

    def run(batches):
        shared, pack, seen = np.unpackbits(np.frombuffer(bits, dtype=np.uint8)).view(bool), _pack(), set()
        for batch in batches:
            for part in textops.pieces(batch):
                keys, values = [], []
                for text in textops.texts_of(part.column("text")).to_pylist():
                    for c in chunks(encode(payload(text))):
                        key = digest(c)
                        if shared[_place(key)] and key not in seen:
                            if len(seen) > 200_000:
                                seen.clear()
                            seen.add(key)
                            keys.append(key)
                            values.append(pack.compress(c))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(values, pa.binary())], ["digest", "data"])

    return run


_TOLD = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
_TOLD_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]


def _whole(name: bytes, got: list[bytes], wanted: int) -> tuple:
    """What is told of a file that its chunks make up; it must be the one that was stored."""
    if len(got) != wanted:
        raise ValueError(f"a file has {len(got)} of its {wanted} chunks")
    file = b"".join(got)
    sha = hashlib.sha256(file)
    if sha.digest() != name[:32]:
        raise ValueError("a file isn't as it was stored")
    samples = decode(file)
    return len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(file), sha.hexdigest(), features(samples)


def _read_own(batches):
    """Files all of whose chunks stand in their own row."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for name, keys, data in zip(*(batch.column(c).to_pylist() for c in ("file", "chunks", "own")), strict=True):
            got = [unpack.decompress(d) for d in data]
            if [digest(c) for c in got] != keys:
                raise ValueError("a chunk isn't as it was stored")
            rows.append(_whole(name, got, len(keys)))
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TOLD_KINDS, strict=True))], ["doc_id", "n_bytes", *_TOLD_NAMES])


_TOLD_NAMES = [f.split()[0] for f in _TOLD.split(", ")]


def _read(batches):
    """Files from their chunks, which come in order; verified, decoded and described."""
    unpack = zstandard.ZstdDecompressor()
    name, got, wanted = None, [], 0

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.binary(), *_TOLD_KINDS], strict=True)], ["file", *_TOLD_NAMES])

    for batch in batches:
        rows = []
        for file, n, seq, key, data in zip(*(batch.column(c).to_pylist() for c in ("file", "n_chunks", "seq", "digest", "data")), strict=True):
            if file != name:
                if name is not None:
                    rows.append((name, *_whole(name, got, wanted)))
                name, got, wanted = file, [], n
            chunk = unpack.decompress(data)
            if seq != len(got) or digest(chunk) != key:
                raise ValueError("a chunk isn't as it was stored")
            got.append(chunk)
        if rows:
            yield batch_of(rows)
    if name is not None:
        yield batch_of([(name, *_whole(name, got, wanted))])


def store(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Writes docs (doc_id, text) as media and returns the two written tables.

    lists: doc_id, n_bytes, file, chunks (digests in order), own (data of the chunks that are in no other place; null for others).
    pool: digest, data of all other chunks, each once.
    """
    docs = docs.select("doc_id", "text")
    bits = np.packbits(repeated(docs)).tobytes()
    lists = durable(docs.mapInArrow(_lists(bits), "doc_id long, n_bytes long, file binary, chunks array<binary>, own array<binary>"))
    return lists, durable(docs.select("text").mapInArrow(_shared(bits), "digest binary, data binary").groupBy("digest").agg(F.first("data").alias("data")))


def read(lists: DataFrame, pool: DataFrame) -> DataFrame:
    """The media of the tables of store(): doc_id, n_bytes, and what _TOLD says of each file that was put together and verified.

    A file whose chunks all are its own is read where it stands. Of the others each is put together once, whatever the number of documents.
    """
    lacks = F.exists("own", lambda d: d.isNull())
    alone = lists.where(~lacks).mapInArrow(_read_own, f"doc_id long, n_bytes long, {_TOLD}")
    files = durable(lists.where(lacks).select("file", "chunks", "own").dropDuplicates(["file"]))
    places = files.select("file", F.size("chunks").alias("n_chunks"), F.posexplode(F.arrays_zip("chunks", "own")).alias("seq", "c"))
    columns = ["file", "n_chunks", "seq", "digest", "data"]
    places = places.select("file", "n_chunks", "seq", F.col("c.chunks").alias("digest"), F.col("c.own").alias("data"))
    wanted = places.where("data is null").drop("data")
    spread = wanted.groupBy("digest").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LANE).select("digest", F.ceil(F.col("_n") / LANE).cast("int").alias("_lanes"))
    wanted = wanted.join(spread, "digest", "left")
    found = wanted.where("_lanes is null").join(pool, "digest").select(columns)
    copies = pool.join(spread, "digest").withColumn("_lane", F.explode(F.sequence(F.lit(0), F.col("_lanes") - 1))).drop("_lanes")
    laned = wanted.where("_lanes is not null").withColumn("_lane", F.pmod(F.xxhash64("file"), F.col("_lanes")).cast("int"))
    found = found.union(laned.join(copies, ["digest", "_lane"]).select(columns)).union(places.where("data is not null").select(columns))
    made = found.repartition("file").sortWithinPartitions("file", "seq").mapInArrow(_read, f"file binary, {_TOLD}")
    lost = F.raise_error(F.lit("a file has none of its chunks"))
    rest = lists.where(lacks).select("doc_id", "n_bytes", "file").join(made, "file", "left").withColumn("media_sha256", F.coalesce("media_sha256", lost)).drop("file")
    return alone.unionByName(rest)


def store_and_read(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> doc_id, sizes, digests and features of the media that were stored and read back."""
    return read(*store(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every whole text as media, stored in chunks and read back."""
    return store_and_read(table(spark, sf_dir, "documents"))


__all__ = ["chunks", "cuts", "decode", "encode", "features", "payload", "query", "read", "store", "store_and_read"]

"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

A shard is two files. ``*.rec`` holds records one after another:

    length of the payload   8 bytes   little-endian
    masked checksum of it   4 bytes
    payload
    masked checksum of it   4 bytes

The payload says whether the document has an id (1 byte), then comes the id (8 bytes, signed, 0 without one), the
number of token ids (4), the width of one in bytes (1) and the token ids, little-endian, as one zstd frame. A masked checksum is CRC-32 rotated right by 15
bits plus 0xA282EAD8, so that a checksum stored among checked bytes doesn't check itself. ``*.idx`` holds,
per record, its offset, its length, whether it has an id and the id (4 x 8 bytes), then the masked checksum of
all that: a reader in any order needs the index and one seek per record.

Texts are range-partitioned by id before they are encoded (the ids of a text never travel), and each
task streams its range to files named by the attempt. Which files count is said by the manifest,
a Parquet table that Spark commits with the job: files of lost or repeated attempts are not in it.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import fs_path, staged
from strata.session import scratch_path

END_ID = 1
_CACHE_WORDS = 600_000  # a call may add its own words once
_ENCODED = 256  # texts of one call
_HEAD = "<?qIB"
MANIFEST = "file string, least long, n_docs long, n_tokens long, n_bytes long, part int"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


# -- encoding -----------------------------------------------------------------------------------------

def drops_blanks(spec: dict) -> bool:
    """True if the tokenizer's file says that words between blanks are encoded on their own: runs of
    blanks become one blank, and only pieces without blanks are kept."""
    norm, pre = json.dumps(spec.get("normalizer")), spec.get("pre_tokenizer") or {}
    split = (pre.get("pretokenizers") or [pre])[0]
    pattern = (split.get("pattern") or {}).get("Regex", "")
    return (r'"Regex": "\\s+"' in norm and split.get("type") == "Split" and split.get("behavior") == "Removed"
            and split.get("invert") is True and pattern.endswith(r"|[^\s\p{L}\p{N}]+") and not spec.get("post_processor")
            and any(n.get("type") == "Lowercase" for n in (spec["normalizer"].get("normalizers") or []))
            and all(not t["content"].isupper() and t["content"].startswith("<|") for t in spec.get("added_tokens", [])))


def maps_bytes(spec: dict) -> bool:
    """True if the pieces are then written byte by byte in the byte-level alphabet and split no further."""
    rest = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [])[1:]
    return len(rest) == 1 and rest[0].get("type") == "ByteLevel" and not rest[0].get("add_prefix_space") and rest[0].get("use_regex") is False


def _byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


#: Lower-case letters of ASCII and all letters of Latin-1, in UTF-8: composed already.
_LATIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
#: Marks that end a word as one piece of their own; the apostrophe may begin a piece with letters.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(97, 123)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[9, 10, 11, 12, 13, 32]] = True


def apart(text: bytes) -> bytes:
    """The text with a blank before each full stop and comma, if each stands between a letter or digit
    and a blank or the end: it is a piece of its own then, and words with and without it become one."""
    b = np.frombuffer(text, dtype=np.uint8)
    at = np.flatnonzero((b == 46) | (b == 44))
    if not len(at):
        return text
    last = at[-1] == len(b) - 1
    if at[0] < 2 or not _ENDS[b[at[:len(at) - last] + 1]].all():
        return text
    before = b[at - 1]
    if not (_ALNUM[before] | ((b[at - 2] == 0xC3) & (before >= 0x9F) & (before != 0xB7))).all():
        return text
    return text.replace(b".", b" .").replace(b",", b" ,")


class Encoder:
    """Encodes whole texts. Where words are encoded on their own, each different word is encoded once
    and kept, up to a bound; other tokenizers get the whole text.

    Lower-case Latin letters need neither normalising nor splitting, so words of these go to the same
    model without the steps before it.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = drops_blanks(spec)
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.known: dict[bytes, bytes] = {}
        zero = self._ids("0") if self.by_word else []
        self.zero = zero[0] if len(zero) == 1 else None
        self.alphabet, self.bare = {b: c for b, c in enumerate(_byte_alphabet()) if b != 32}, None
        if self.zero is not None and maps_bytes(spec):
            suffix = self.tokenizer.model.end_of_word_suffix
            if suffix:  # the last id of a word says so
                self.bare = Tokenizer(self.tokenizer.model)
                self.bare.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
                self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
                self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _listed(self, tokenizer, keys: list[bytes], written: list[bytes], between: bytes, ends_at) -> dict[bytes, bytes]:
        """Ids of many texts in few calls. ``ends_at`` finds where a text's ids end; ``between`` may be a word of its own there."""
        out, size, gap = {}, self.dtype.itemsize, self.dtype.itemsize * (between != b" ")
        parts = range(0, len(keys), 128)
        texts = [(between.join(written[i:i + 128]) + between).decode() for i in parts]
        for i, e in zip(parts, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, dtype=self.dtype)
            ends = np.flatnonzero(ends_at(ids)) * size + (size - gap)
            raw = ids.tobytes()
            out.update(zip(keys[i:i + 128], [raw[x:y] for x, y in zip([0, *(ends[:-1] + gap).tolist()], ends.tolist())], strict=True))
        return out

    def _words(self, keys: list[bytes], written: list[bytes]) -> dict[bytes, bytes]:
        return self._listed(self.bare, keys, written, b" ", lambda ids: self.last[ids])

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of ``words``, none of them known. Letters with marks behind them are put together of both."""
        ends = {}
        if self.bare is not None:
            for w in words:
                head = w.rstrip(_MARKS)
                if 0 < len(head) < len(w) and _LATIN(head):
                    ends[w] = head, w[len(head):]
            words = words - ends.keys() | {x for pair in ends.values() for x in pair if x not in self.known}
        out = self._whole(words)
        for w, pair in ends.items():
            head, tail = (out[x] if x in out else self.known[x] for x in pair)
            out[w] = head + tail
        return out

    def _whole(self, words: set[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        if self.bare is not None:
            ascii_ = [w for w in words if w.isalpha() and w.islower()]  # its own byte-level alphabet
            out.update(self._words(ascii_, ascii_))
            latin = [w for w in words - out.keys() if _LATIN(w)]
            lowered = b" ".join(latin).decode().lower().encode()
            out.update(self._words(latin, lowered.decode("latin-1").translate(self.alphabet).encode().split(b" ") if latin else []))
        if self.zero is not None:
            plain = [w for w in words - out.keys() if b"0" not in w]  # between two a 0, whose id these don't have
            out.update(self._listed(self.tokenizer, plain, plain, b" 0 ", lambda ids: ids == self.zero))
        for w in words - out.keys():
            out[w] = np.array(self._ids(w.decode()), dtype=self.dtype).tobytes()
        return out

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text as little-endian bytes."""
        if not self.by_word:
            for t in texts:
                yield np.array(self._ids(t.decode()), dtype=self.dtype).tobytes()
            return
        # ASCII letters and blanks only. Special tokens are looked for before letters are lowered, and
        # accents of their own (U+0300 to U+033F) are composed before: there are letters with lower case only
        ready = [t if b"<|" in t or b"\xcc" in t else apart(t.lower()) for t in texts]
        words = pc.ascii_split_whitespace(pa.array(ready, pa.large_binary()).view(pa.large_string()))
        coded = words.flatten().dictionary_encode()
        keys = coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > _CACHE_WORDS:
            self.known.clear()
        self.known[b""] = b""  # before a leading blank, behind a trailing one
        found = list(map(self.known.get, keys))
        new = [i for i, x in enumerate(found) if x is None]
        learnt = self._learn({keys[i] for i in new})
        self.known.update(learnt)
        for i in new:
            found[i] = learnt[keys[i]]
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        at = np.r_[0, pc.binary_length(ids).to_numpy(zero_copy_only=False).cumsum()][np.asarray(words.offsets)].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        for a, b in zip(at, at[1:]):
            yield bytes(raw[a:b])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker and file: a worker that goes on to another task keeps what it has encoded."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# -- writing ------------------------------------------------------------------------------------------

def write_records(docs: DataFrame, tokenizer: str, path: str | None = None, id_col: str = "doc_id",
                  text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encodes and writes ``docs`` below ``path`` (a fresh shared folder if None) in ascending id order and
    returns the manifest: one row per shard, ``shard`` in id order and ``start``, the ids before it.

    ``tokenizer`` is a file of the tokenizers library that the workers can read. Null and blank texts
    become records of the end id alone; a null id sorts first and is read back as null; rows of
    one id are ordered by text; other columns are not read; an empty table makes an empty manifest.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "records")
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    ordered = slim.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def run(batches):
        enc, pack = encoder(tokenizer), zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        size = enc.dtype.itemsize
        part, out, index = TaskContext.get().partitionId(), None, []
        least = offset = tokens = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs, base = fs_path(path)
                fs.create_dir(base, recursive=True)
                name = f"part-{part:06d}-{uuid.uuid4().hex}"
                out, least = fs.open_output_stream(f"{base}/{name}.rec"), batch.column(0)[0].as_py()
            texts = batch.column(1).cast(pa.binary())
            encoded = (x for i in range(0, len(texts), _ENCODED) for x in enc.encode(texts.slice(i, _ENCODED).to_pylist()))
            for doc, raw in zip(batch.column(0).to_pylist(), encoded):
                raw += end
                n = len(raw) // size
                payload = struct.pack(_HEAD, doc is not None, doc or 0, n, size) + pack.compress(raw)
                length = struct.pack("<Q", len(payload))
                out.write(b"".join([length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))]))
                index.append((offset, len(payload), doc is not None, doc or 0))
                offset += len(payload) + 16
                tokens += n
        if out is not None:
            out.close()
            table = np.array(index, dtype="<i8").tobytes()
            with fs.open_output_stream(f"{base}/{name}.idx") as f:
                f.write(table + struct.pack("<I", masked(table)))
            yield pa.RecordBatch.from_pydict({"file": [name], "least": [least], "n_docs": [len(index)], "n_tokens": [tokens],
                                              "n_bytes": [offset], "part": pa.array([part], pa.int32())})

    made = staged(ordered.mapInArrow(run, MANIFEST), "manifest")
    by_key = Window.orderBy("least", "part")  # one small row per shard
    return made.select(
        (F.row_number().over(by_key) - 1).alias("shard"), F.concat(F.lit(path.rstrip("/") + "/"), "file").alias("file"), "n_docs", "n_tokens", "n_bytes",
        F.coalesce(F.sum("n_tokens").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("start"))


# -- reading ------------------------------------------------------------------------------------------

def read_index(fs, path: str) -> np.ndarray:
    """(offset, length, 1 if there is an id, doc_id) per record; raises if the index is damaged."""
    with fs.open_input_file(path) as f:
        raw = f.read()
    if len(raw) < 4 or masked(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
        raise ValueError(f"{path}: the index doesn't match its checksum")
    return np.frombuffer(raw[:-4], dtype="<i8").reshape(-1, 4)


def parse(record: bytes) -> tuple[int | None, np.ndarray]:
    """(doc_id, ids) of one framed record; raises if a checksum doesn't match."""
    length, check = struct.unpack_from("<QI", record)
    payload = record[12:12 + length]
    if masked(record[:8]) != check or len(record) != length + 16 or masked(payload) != struct.unpack_from("<I", record, 12 + length)[0]:
        raise ValueError("a record doesn't match its checksum")
    known, doc, n, size = struct.unpack_from(_HEAD, payload)
    raw = zstandard.ZstdDecompressor().decompress(payload[struct.calcsize(_HEAD):], max_output_size=max(1, n * size))
    return doc if known else None, np.frombuffer(raw, dtype=f"<u{size}")


def read_records(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """One row per record, read from the files of the manifest: shard, place (in the shard), doc_id,
    start (ids of all records before it), n_tokens, ids_crc32 (of the ids as 32-bit little-endian) and
    ids_bytes (as stored, 2 or 4 bytes an id: see ``width``; null unless ``with_ids``)."""
    spark = manifest.sparkSession
    rows = staged(manifest, "shards")
    n = max(1, rows.count())

    def run(batches):
        for batch in batches:
            for shard, file, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                fs, base = fs_path(file)
                index = read_index(fs, base + ".idx")
                with fs.open_input_stream(base + ".rec") as f:
                    for lo in range(0, len(index), 512):
                        out = []
                        for place, (offset, length, known, doc) in enumerate(index[lo:lo + 512].tolist(), lo):
                            doc = doc if known else None
                            found, ids = parse(f.read(length + 16))
                            if found != doc:
                                raise ValueError(f"{file}: record {place} isn't the one the index names")
                            out.append((shard, place, doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), ids.itemsize, ids.tobytes() if with_ids else None))
                            start += len(ids)
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    schema = "shard int, place long, doc_id long, start long, n_tokens long, ids_crc32 long, width int, ids_bytes binary"
    names = [x.split()[0] for x in schema.split(", ")]
    typed = spark.createDataFrame([], schema).schema

    def cast(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        want = to_arrow_schema(typed)
        for b in run(batches):
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, want)], schema=want)

    return rows.select("shard", "file", "start").repartition(n).mapInArrow(cast, typed)


def read_shuffled(manifest: DataFrame, seed: int = 0) -> DataFrame:
    """(position, doc_id, ids): every record once, in a seeded order over all shards; only index rows are
    shuffled, and each record is then read by a seek."""
    rows = staged(manifest.select("shard", "file"), "shards")

    def entries(batches):
        for batch in batches:
            for shard, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, base = fs_path(file)
                index = read_index(fs, base + ".idx")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * len(index)), pa.array(np.full(len(index), shard), pa.int32()), *(pa.array(index[:, i]) for i in range(2))],
                    names=["file", "shard", "offset", "length"])

    def fetch(batches):
        open_files: dict = {}
        for batch in batches:
            docs, ids = [], []
            for file, offset, length in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if file not in open_files:
                    if len(open_files) >= 64:
                        open_files.pop(next(iter(open_files))).close()
                    fs, base = fs_path(file)
                    open_files[file] = fs.open_input_file(base + ".rec")
                doc, x = parse(open_files[file].read_at(length + 16, offset))
                docs.append(doc)
                ids.append(x.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(4), pa.array(docs, pa.int64()), pa.array(ids, pa.list_(pa.int32()))],
                                             names=["position", "doc_id", "ids"])

    order = F.xxhash64(F.lit(seed), "shard", "offset")
    return (rows.mapInArrow(entries, "file string, shard int, offset long, length long").withColumn("position", order)
            .repartitionByRange("position").sortWithinPartitions("position")
            .mapInArrow(fetch, "position long, doc_id long, ids array<int>"))


def digest(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes ``docs`` and returns what reading the files back says of each record."""
    return read_records(write_records(docs, tokenizer), with_ids=False).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "shard", "place")

"""Token ids of documents in files of separately compressed documents, with one dictionary for all.

``train`` makes a zstandard dictionary from the serialized id arrays of a bounded sample. ``write`` range-partitions the documents by
id, encodes each text, serializes its ids (little-endian, two bytes an id where the vocabulary allows, else four) and compresses every document on its
own with the dictionary, so a short document costs neither its neighbours nor a header of its own. ``read`` goes through whole
files; ``fetch`` reads single documents as byte ranges that the offset index names.

A file: magic, SHA-256 of the dictionary, the width of an id in one byte; the frames; the index as a zstandard-compressed Arrow stream
(doc_id, offset, length, n_tokens); the length of the index in eight bytes, magic. ``manifest.json`` lists the files in order with the ids before each, and
the dictionary lies beside them under its hash. A reader refuses a dictionary whose hash is another than that of the file.

Files are named by attempt, and only rows of successful attempts get into the manifest, so lost executors and repeated attempts do no harm.

Defined results: a null or empty text has the end id alone. Null ids come first; equal ids are in the order of a hash of the text, and repeated rows
have a document each. An empty table has a manifest without files. With too few documents to train on there is no dictionary, and its hash
is that of no bytes.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewatch.llm.files import file_system
from tidewatch.llm.piece_cache import Encoder, PieceCache, byte_alphabet, flat, text_slices
from tidewatch.session import materialize, shared_dir

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
MAGIC = b"TWIDS001"
HEAD = len(MAGIC) + 33
LEVEL = 3
READ_BYTES = 4_000_000
SLICE_CHARS = 1_000_000
TABLE_PIECES = 300_000
#: Between ASCII white space the vocabulary of words begins anew: its pattern matches no white space, and normalization crosses none.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: In lower-case Latin texts it does so too between letters or digits and other signs, but for the apostrophe before a letter.
LETTERS = r"a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
PLAIN = re.compile(rf"'?[{LETTERS}0-9]+(?:'[{LETTERS}0-9]+)*|[^\x20\x09-\x0D{LETTERS}0-9]+")
ONE_WORD = re.compile(rf"[{LETTERS}]+")
#: Other characters may be composed, or lower-cased by their neighbours.
FURTHER = re.compile("[\u0130\u0250-\U0010ffff]")
#: Full stops and commas next to other signs go with these; elsewhere they can be set apart before the text is split.
MARKED = re.compile(rf"[.,](?:(?<=[^\x20\x09-\x0D{LETTERS}0-9][.,])|[^\x20\x09-\x0D{LETTERS}0-9])|[\x1c-\x1f]")
SPECIAL = "<|"
_caches: dict[str, PieceCache] = {}


def _cache(path: str) -> PieceCache:
    """The tokenizer of this process with its table of known words."""
    if path not in _caches:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _caches[path] = PieceCache([_encoder(Tokenizer.from_file(path))], pieces=TABLE_PIECES)
    return _caches[path]


def _encoder(model) -> Encoder:
    """Ids of pieces. A piece of letters is one word, lower-cased and composed already, so it goes to the vocabulary's model at once, past normalization and cutting."""
    model.model._resize_cache(0)  # pieces come once
    tokenize = model.model.tokenize
    signs = {b: c for c, b in byte_alphabet().items()}

    def word(p: str) -> list[int]:
        return [t.id for t in tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(signs))]

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: list = [word(p) if ONE_WORD.fullmatch(p) and (p.isascii() or p.lower() == p) else None for p in pieces]
        rest = [k for k, x in enumerate(found) if x is None]
        for k, x in zip(rest, model.encode_batch_fast([pieces[k] for k in rest], add_special_tokens=False), strict=True):
            found[k] = x.ids
        return flat(found)

    return encode


def pieces_of(text: str | None) -> list[str]:
    """Parts of a text that are encoded alone; Latin letters are lower-cased, as the vocabulary does."""
    if not text:
        return []
    if SPECIAL in text or not text.isascii() and FURTHER.search(text):
        return WORD.findall(text)
    text = text.lower()
    return PLAIN.findall(text) if MARKED.search(text) else text.replace(".", " . ").replace(",", " , ").split()


def id_width(path: str) -> int:
    """Bytes of a serialized id."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def serialized(texts: list[str | None], path: str, end_id: int, width: int) -> list[bytes]:
    """The ids of each text and ``end_id``."""
    cache = _cache(path)
    rows, first = cache.rows([pieces_of(t) for t in texts])
    ids, each = cache.lists[0].take(rows)
    bounds = np.concatenate(([0], np.cumsum(each)))[first]
    ids = ids.astype(f"<u{width}")
    end = np.array([end_id], f"<u{width}").tobytes()
    return [ids[a:b].tobytes() + end for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def train(docs: DataFrame, path: str = VOCABULARY, end_id: int = 2, sample_docs: int = 2000, sample_chars: int = 4000, size: int = 65536, id_col: str = "doc_id", text_col: str = "text") -> bytes:
    """A dictionary from the documents with the ``sample_docs`` smallest hashes, the first ``sample_chars`` of each; empty if they are too few."""
    rows = docs.select(F.xxhash64(id_col, text_col).alias("_o"), F.col(text_col).alias("_text"))
    last = rows.select("_o").orderBy("_o").limit(sample_docs).agg(F.max("_o")).first()[0]  # the hashes first, so that only texts of the sample travel
    some = rows.where(F.col("_o") <= F.lit(last)).dropDuplicates(["_o"]).select("_o", F.substring("_text", 1, sample_chars).alias("_text")) if last is not None else rows.limit(0)
    samples = serialized([r["_text"] for r in sorted(some.collect(), key=lambda r: r["_o"])], path, end_id, id_width(path))
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _writer(folder: str, dictionary: bytes, path: str, end_id: int, width: int, index_type: pa.Schema):
    digest = hashlib.sha256(dictionary).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_content_size=True)
        store, root = file_system(folder)
        name, out, offset, total, index = f"ids-{uuid.uuid4().hex}.twids", None, HEAD, 0, []
        try:
            for batch, texts in text_slices(batches, "_text", SLICE_CHARS):
                if out is None:
                    out = store.open_output_stream(posixpath.join(root, name), compression=None)
                    out.write(MAGIC + digest + bytes([width]))
                raw = serialized(texts, path, end_id, width)
                frames = [packer.compress(x) for x in raw]
                out.write(b"".join(frames))
                lengths = np.array([len(x) for x in frames], np.int64)
                counts = np.array([len(x) // width for x in raw], np.int64)
                index.append(pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(offset + np.cumsum(lengths) - lengths), pa.array(lengths), pa.array(counts)], schema=index_type))
                offset, total = offset + int(lengths.sum()), total + int(counts.sum())
            if out is not None:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, index_type) as stream:
                    for part in index:
                        stream.write_batch(part)
                data = zstandard.ZstdCompressor(level=LEVEL).compress(sink.getvalue().to_pybytes())
                out.write(data + len(data).to_bytes(8, "little") + MAGIC)
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [name], "n_docs": [sum(len(x) for x in index)], "n_tokens": [total]})

    return run


def write(docs: DataFrame, folder: str, dictionary: bytes, path: str = VOCABULARY, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Write the ids of all documents in ascending id order into ``folder``; the manifest, which has an entry a file."""
    spark = docs.sparkSession
    width = id_width(path)
    kind = docs.schema[id_col]
    types = StructType([StructField("doc_id", kind.dataType), *StructType.fromDDL("offset long, length long, n_tokens long").fields])
    store, root = file_system(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash"), F.monotonically_increasing_id().alias("_n"), F.col(text_col).alias("_text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "_id", "_hash", "_n").sortWithinPartitions("_id", "_hash", "_n").select("_id", "_text")
    files = dealt.mapInArrow(_writer(folder, dictionary, path, end_id, width, _arrow(types, spark)), "part int, file string, n_docs long, n_tokens long")
    listed = sorted(tuple(r) for r in materialize(files, "token-files").collect())  # one row a partition
    manifest = {"dictionary": hashlib.sha256(dictionary).hexdigest(), "width": width, "id_type": json.loads(types["doc_id"].dataType.json()), "files": []}
    start = 0
    for _, name, n_docs, n_tokens in listed:
        manifest["files"].append({"file": name, "n_docs": n_docs, "n_tokens": n_tokens, "start": start})
        start += n_tokens
    for name, data in ((f"{manifest['dictionary']}.zdict", dictionary), ("manifest.json", json.dumps(manifest).encode())):
        with store.open_output_stream(posixpath.join(root, name), compression=None) as out:
            out.write(data)
    return manifest


def _arrow(types: StructType, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(types)


def read_manifest(folder: str) -> dict:
    store, root = file_system(folder)
    with store.open_input_stream(posixpath.join(root, "manifest.json")) as f:
        return json.loads(f.read())


def read_dictionary(folder: str, digest: str) -> bytes:
    store, root = file_system(folder)
    with store.open_input_stream(posixpath.join(root, f"{digest}.zdict")) as f:
        data = f.read()
    if hashlib.sha256(data).hexdigest() != digest:
        raise ValueError("damaged dictionary")
    return data


def _index(f, digest: str) -> tuple[pa.Table, int]:
    """Index and id width of an open file."""
    size = f.size()
    head, tail = f.read_at(HEAD, 0), f.read_at(16, size - 16)
    if head[: len(MAGIC)] != MAGIC or tail[8:] != MAGIC:
        raise ValueError("not a file of token ids")
    if head[len(MAGIC) : -1].hex() != digest:
        raise ValueError("the file was written with another dictionary")
    n = int.from_bytes(tail[:8], "little")
    data = zstandard.ZstdDecompressor().decompress(f.read_at(n, size - 16 - n))
    return pa.ipc.open_stream(data).read_all(), head[-1]


def _files(spark: SparkSession, manifest: dict) -> DataFrame:
    """The files, one a task."""
    rows = [(k, x["file"], x["start"]) for k, x in enumerate(manifest["files"])]
    listed = spark.createDataFrame(rows, "part int, file string, start long")
    return listed.repartitionByRange(max(1, len(rows)), "part") if rows else listed


def _type_of(manifest: dict) -> StructField:
    return StructField("doc_id", StructType.fromJson({"type": "struct", "fields": [{"name": "doc_id", "type": manifest["id_type"], "nullable": True, "metadata": {}}]})["doc_id"].dataType)


def read(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in the files; ``start`` counts the ids of all documents before it."""
    manifest = read_manifest(folder)
    digest, more = manifest["dictionary"], ", ids array<long>" * ids
    schema = StructType([_type_of(manifest), *StructType.fromDDL("start long, n_tokens long, ids_crc32 long" + more).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = None
        store, root = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                opener = opener or zstandard.ZstdDecompressor(dict_data=_dictionary(read_dictionary(folder, digest)))
                with store.open_input_file(posixpath.join(root, row["file"])) as f:
                    index, width = _index(f, digest)
                    offsets, lengths, counts = (index.column(c).to_numpy() for c in ("offset", "length", "n_tokens"))
                    starts = row["start"] + np.cumsum(counts) - counts
                    # consecutive frames of some megabytes of ids in one read
                    cost = np.cumsum(lengths + counts * 4)
                    cuts = np.flatnonzero(np.diff(cost // READ_BYTES, prepend=-1))
                    for a, b in zip(cuts, [*cuts[1:], len(cost)], strict=True):
                        data = memoryview(f.read_at(int(offsets[b - 1] + lengths[b - 1] - offsets[a]), int(offsets[a])))
                        found = [np.frombuffer(opener.decompress(data[offsets[k] - offsets[a] :][: lengths[k]]), f"<u{width}") for k in range(a, b)]
                        if any(len(x) != n for x, n in zip(found, counts[a:b], strict=True)):
                            raise ValueError(f"damaged file {row['file']}")
                        own = [index.column("doc_id").slice(a, b - a).combine_chunks(), pa.array(starts[a:b]), pa.array(counts[a:b]), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64())]
                        if ids:
                            own.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts[a:b]))), pa.int32()), pa.array(np.concatenate(found).astype(np.int64))))
                        yield pa.RecordBatch.from_arrays(own, names=schema.names)

    return _files(spark, manifest).mapInArrow(run, schema)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, file, offset, length, n_tokens, start) of every document, from the ends of the files."""
    manifest = read_manifest(folder)
    digest = manifest["dictionary"]
    schema = StructType([_type_of(manifest), *StructType.fromDDL("file string, offset long, length long, n_tokens long, start long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(posixpath.join(root, row["file"])) as f:
                    table, _ = _index(f, digest)
                counts = table.column("n_tokens").to_numpy()
                columns = [table.column("doc_id").combine_chunks(), pa.array([row["file"]] * len(table)), *(table.column(c).combine_chunks() for c in ("offset", "length", "n_tokens")), pa.array(row["start"] + np.cumsum(counts) - counts)]
                yield from pa.Table.from_arrays(columns, names=schema.names).to_batches(max_chunksize=10_000)

    return _files(spark, manifest).mapInArrow(run, schema)


def fetch(spark: SparkSession, folder: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, ids) of the documents with the ids of ``wanted``, each by a read of its own frame; null ids are not found."""
    manifest = read_manifest(folder)
    digest = manifest["dictionary"]
    keys = wanted.select(F.col(id_col).alias("doc_id")).distinct()
    found = index(spark, folder).join(keys, "doc_id", "left_semi").repartition("file", "doc_id").sortWithinPartitions("file", "offset")
    schema = StructType([_type_of(manifest), *StructType.fromDDL("start long, ids array<long>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        opener = width = f = name = None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    opener = opener or zstandard.ZstdDecompressor(dict_data=_dictionary(read_dictionary(folder, digest)))
                    if row["file"] != name:
                        if f is not None:
                            f.close()
                        name, f = row["file"], store.open_input_file(posixpath.join(root, row["file"]))
                        width = f.read_at(HEAD, 0)[-1]
                    ids = np.frombuffer(opener.decompress(f.read_at(row["length"], row["offset"])), f"<u{width}")
                    one = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids.astype(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array([row["doc_id"]], batch.schema.field("doc_id").type), pa.array([row["start"]]), one], names=schema.names)
        finally:
            if f is not None:
                f.close()

    return found.mapInArrow(run, schema)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own for files, in the shared folder of the session."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/token-files-{uuid.uuid4().hex}"

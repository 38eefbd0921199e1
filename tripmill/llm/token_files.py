"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

A token folder holds, per part, three flat little-endian files that can be memory-mapped:

- ``*.ids``: token ids, ``uint16`` if the vocabulary allows it, else ``uint32``;
- ``*.off``: ``int64`` offsets into the ids of that part, one more than there are documents;
- ``*.doc``: the documents' ids, ``int64`` followed by one byte that is 1 where the id is null.

``manifest`` (Parquet) names the files of each part, in order, with the number of ids in all parts
before it (its base, a prefix sum). The position of a document in the whole corpus is the base of its
part plus its offset. File names are unique to a task attempt and only attempts that Spark commits
reach the manifest, so a repeated task leaves at worst a file nobody refers to.

Cases: a null text is an empty one; an empty text has the end id only. Documents stand in ascending
order of doc_id, null first; documents of equal id in the order of their text's hash. An empty table
gives an empty manifest and no documents. Other columns are ignored.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import common

END_ID = 2
_DOC_TYPE = [("id", "<i8"), ("null", "u1")]
# Words kept with their ids in each worker process; the table is emptied when it is full.
_CACHED_WORDS = 700_000
# Bytes of text encoded at a time.
_SLICE_BYTES = 8 << 20
# How the tokenizers that the short way serves cut a text, and the same for Latin letters only.
_CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_CUT_LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\s\w]|_)+")
_LATIN = re.compile(r"[!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u0239]*")
_LATIN_LETTERS = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{239}]+$"
_MANIFEST_ARROW = [("part", "int64"), ("file", "string"), ("n_docs", "int64"), ("n_tokens", "int64"), ("width", "int32")]
_MANIFEST = "part long, file string, n_docs long, n_tokens long, width int"


class WordEncoder:
    """Encodes texts through a cache of words.

    For a tokenizer that drops white space and never joins what it separates, the ids of a text are the
    ids of its words one after another. Texts are cut at spaces and line feeds only; whatever other
    white space is left within a piece is handled by the tokenizer. Words of Latin letters take a short
    way: lower case, cut as the tokenizer cuts, and merged by the tokenizer's own model.
    """

    def __init__(self, tokenizer_file: str, width: int, limit: int = _CACHED_WORDS) -> None:
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.width, self.limit = width, limit
        self.known: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        self.packed = [i.to_bytes(width, "little") for i in range(self.tokenizer.get_vocab_size())]
        layout = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (layout["normalizer"] or {}).get("normalizers", [])]
        cuts = [x.get("pattern") for x in (layout["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.short_way = steps == ["NFC", "Replace", "Lowercase"] and cuts == [{"Regex": _CUT_PATTERN}, None]
        self.bytes = _byte_letters()

    def word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            if self.short_way and _LATIN.fullmatch(word) and "<|" not in word:
                ids = b"".join(map(self.piece, _CUT_LATIN.findall(word.lower())))
            else:
                ids = self.pack(self.tokenizer.encode(word, add_special_tokens=False).ids)
            self.known[word] = ids
        return ids

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            letters = piece if piece.isascii() else "".join(map(self.bytes.__getitem__, piece.encode()))
            ids = self.pieces[piece] = b"".join([self.packed[t.id] for t in self.model.tokenize(letters)])
        return ids

    def pack(self, ids: list[int]) -> bytes:
        return b"".join([self.packed[i] for i in ids])

    def __call__(self, texts, end_id: int):
        """The ids of an Arrow array of texts, each followed by the end id, and where each text ends."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if len(self.known) > self.limit // 3:
            self.known = {"": b""}
        if len(self.pieces) > self.limit:
            self.pieces = {}
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        # A text without words is a list of one empty word, so no list is empty.
        coded = words.flatten().dictionary_encode()
        plain = pc.match_substring_regex(coded.dictionary, _LATIN_LETTERS if self.short_way else "^$")
        lower = pc.if_else(plain, pc.utf8_lower(coded.dictionary), None)
        lower = lower.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist
        codes = list(map(self.pieces.get, lower))
        new = np.flatnonzero(np.fromiter((x is None for x in codes), bool, len(codes)))
        for at, word in zip(new.tolist(), coded.dictionary.take(pa.array(new)).to_numpy(zero_copy_only=False)):
            codes[at] = self.word(word) if lower[at] is None else self.piece(lower[at])
        every = np.frombuffer(b"".join(codes), dtype=f"<u{self.width}")
        lengths = np.fromiter(map(len, codes), "int32", len(codes)) // self.width
        starts = np.cumsum(lengths, dtype="int64") - lengths
        at = coded.indices.to_numpy()
        counts = lengths[at]
        before = np.cumsum(counts, dtype="int64") - counts
        ids = every[np.repeat(starts[at] - before, counts) + np.arange(counts.sum())]
        heads = words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()
        sizes = np.add.reduceat(counts, heads, dtype="int64")
        ends = np.cumsum(sizes)
        return np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _encoder(tokenizer_file: str, width: int) -> WordEncoder:
    """One encoder per worker process, which serves many tasks."""
    kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders"))
    if getattr(kept, "key", None) != (tokenizer_file, width):
        kept.key, kept.encoder = (tokenizer_file, width), WordEncoder(tokenizer_file, width)
    return kept.encoder


def _slices(texts, limit: int = _SLICE_BYTES):
    """Bounds of runs of texts of about ``limit`` bytes, a longer text by itself."""
    import numpy as np
    import pyarrow.compute as pc

    total = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(total):
        used = int(total[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(total, used + limit, "right")))
        yield at, to
        at = to


def vocabulary_width(tokenizer_file: str) -> int:
    """Bytes per id."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer_file).get_vocab_size() <= 1 << 16 else 4


def write_tokens(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """Encode all documents (doc_id, text) into ``folder`` and return its manifest."""
    width = vocabulary_width(tokenizer_file)

    def write(batches: Iterator) -> Iterator:
        import gc
        import os
        import uuid

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        gc.disable()
        encode = _encoder(tokenizer_file, width)
        part = TaskContext.get().partitionId()
        name, streams = f"part-{part:06d}-{uuid.uuid4().hex}", None
        n_docs = n_tokens = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if streams is None:
                system, path = common.file_system(folder)
                system.create_dir(path, recursive=True)
                streams = {k: system.open_output_stream(f"{path}/{name}.{k}") for k in ("ids", "off", "doc")}
                streams["off"].write(np.zeros(1, "<i8").tobytes())
            docs = np.zeros(batch.num_rows, _DOC_TYPE)
            docs["null"] = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            docs["id"] = batch["doc_id"].fill_null(0).to_numpy()
            streams["doc"].write(docs.tobytes())
            n_docs += batch.num_rows
            for a, b in _slices(batch["text"]):
                ids, ends = encode(batch["text"].slice(a, b - a), end_id)
                streams["ids"].write(ids.tobytes())
                streams["off"].write((ends + n_tokens).astype("<i8").tobytes())
                n_tokens += len(ids)
        if streams:
            for stream in streams.values():
                stream.close()
            row = {"part": [part], "file": [name], "n_docs": [n_docs], "n_tokens": [n_tokens], "width": [width]}
            yield pa.RecordBatch.from_pydict(row, pa.schema(_MANIFEST_ARROW))

    texts = docs.select("doc_id", common.text_or_empty().alias("text"))
    ordered = texts.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    parts = common.stage(ordered.mapInArrow(write, _MANIFEST), "token-parts")
    manifest = with_bases(parts)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def with_bases(parts: DataFrame) -> DataFrame:
    """Add to each part the number of ids before it; one row per part, not per document."""
    rows, base = [], 0
    for row in sorted(parts.collect()):
        rows.append((*row, base))
        base += row["n_tokens"]
    return parts.sparkSession.createDataFrame(rows, f"{_MANIFEST}, base long")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{_MANIFEST}, base long").parquet(f"{folder}/manifest")


def map_array(folder: str, name: str, dtype):
    """A flat file as an array: memory-mapped from a file system of the machine, else read."""
    import numpy as np
    from pyarrow import fs

    system, path = common.file_system(folder)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", dtype=dtype, mode="r")
    with system.open_input_file(f"{path}/{name}") as stream:
        return np.frombuffer(stream.read(), dtype=dtype)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the CRC-32 of its ids as 32-bit integers."""

    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        for batch in batches:
            for row in batch.itertuples():
                ids = map_array(folder, f"{row.file}.ids", f"<u{row.width}")
                offsets = map_array(folder, f"{row.file}.off", "<i8")
                docs = map_array(folder, f"{row.file}.doc", np.dtype(_DOC_TYPE))
                for at in range(0, len(docs), 10_000):
                    chosen, bounds = docs[at : at + 10_000], offsets[at : at + 10_001].tolist()
                    crcs = [
                        zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds, bounds[1:])
                    ]
                    yield pd.DataFrame(
                        {
                            "doc_id": pd.array(chosen["id"], dtype="Int64").copy(),
                            "start": row.base + np.array(bounds[:-1], "int64"),
                            "n_tokens": np.diff(bounds),
                            "ids_crc32": np.array(crcs, "int64"),
                        }
                    ).assign(doc_id=lambda x: x["doc_id"].mask(chosen["null"] == 1))

    # One row per part; they are dealt over all cores.
    manifest = spark.createDataFrame(read_manifest(spark, folder).collect(), f"{_MANIFEST}, base long")
    return manifest.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")

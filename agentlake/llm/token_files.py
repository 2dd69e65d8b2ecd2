"""Token ids in binary files of independent zstandard frames that end in a seek table.

File layout (all numbers little-endian):

1. data frames: each an independent zstandard frame with content checksum, holding unsigned 32-bit ids of one or more
   whole documents (a document above ``frame_bytes`` is cut over several frames);
2. a skippable frame (magic 0x184D2A50) with the zstandard-compressed document index: 64-bit doc_ids, a byte per
   document that tells whether its doc_id is present, and 64-bit token counts;
3. a seek table in the zstandard seekable format: a skippable frame (magic 0x184D2A5E) of (compressed size, size,
   checksum) per data frame, then the frame count, a flag byte 0x80 and the magic 0x8F92EAB1. The checksum is the low
   half of xxHash64 of the frame's content.

A reader needs the last nine bytes to find the table, and then fetches only frames with documents that it wants. Any
zstandard program can decompress a whole file.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agentlake.llm.words import slices

# Fixed values of the zstandard seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_BYTES = 256 << 10
#: Bytes of text of a file.
FILE_BYTES = 16 << 20
#: Distinct words whose ids a worker process keeps (about 200 bytes each), beside those of one slice of texts.
CACHED_WORDS = 500_000


@lru_cache(maxsize=2)
def word_encoder(path: str, end_id: int, most_words: int | None = None) -> WordEncoder:
    """The encoder of a worker process; later tasks find the words that earlier ones learned."""
    return WordEncoder(path, end_id, most_words)


#: Letters of Latin-1 beside ASCII. Like printable ASCII they don't compose with each other, and fold one by one.
LATIN = "À-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[!-~{LATIN}]+")
#: Patterns by which tokenizers cut words into pieces, and what they come to in words of plain characters.
PIECES = {
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+": re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z{LATIN}]+|[0-9]|[^A-Za-z0-9{LATIN}]+"),
}
PLAIN_STEPS = ({"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "})


def _piece_pattern(settings: dict) -> re.Pattern | None:
    """How the tokenizer cuts folded words of plain characters into the pieces that its model encodes one by one; None where
    it may do more than compose, fold, cut by a known pattern and spell bytes."""
    normalizer, cutter = settings["normalizer"] or {}, settings["pre_tokenizer"] or {}
    steps, cuts = normalizer.get("normalizers", [normalizer]), cutter.get("pretokenizers", [])
    if settings["model"]["type"] != "BPE" or settings["model"].get("dropout") or any(x not in PLAIN_STEPS for x in steps) or len(cuts) != 2:
        return None
    split, spell = cuts
    if (split["type"], split.get("behavior"), split.get("invert")) != ("Split", "Removed", True):
        return None
    if (spell["type"], spell.get("add_prefix_space"), spell.get("use_regex")) != ("ByteLevel", False, False):
        return None
    return PIECES.get(split["pattern"].get("Regex"))


class _Numbers(dict):
    """Numbers words as they come; the empty one, which edges of texts leave, has no place among them."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        if not word:
            return -1
        number = self[word] = len(self) + 1  # 0 is the end of a document
        self.new.append(word)
        return number


class WordEncoder:
    """Encodes texts word by word with a tokenizer that never joins across ASCII white space and drops it, keeping the
    ids of words seen before. Equal to encoding whole texts for such a tokenizer (word-level pre-tokenizers whose
    pieces and special tokens hold no white space). Words of ASCII alone are folded first if the tokenizer folds, which
    leaves fewer different words; in others a mark may compose with one case of its letter only. New words of plain
    characters go to the tokenizer's model piece by piece, if it cuts words in a way known here, all others through the
    whole tokenizer, which takes twice the time."""

    def __init__(self, path: str, end_id: int, most_words: int | None = None):
        self.most_words = most_words or CACHED_WORDS
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        added = list(self.tokenizer.get_added_tokens_decoder().items())
        self.added = [t.content.encode() for _, t in added]
        # a special token between words keeps them apart, and its id tells where one ends
        special = [(t.content, i) for i, t in added if t.special and not (t.lstrip or t.rstrip or t.single_word)]
        self.border, self.border_id = special[-1] if special else (None, -1)
        with open(path, "rb") as file:
            settings = json.load(file)
        self.fold = any(x["type"] == "Lowercase" for x in (settings["normalizer"] or {}).get("normalizers", []))
        self.cut = _piece_pattern(settings)
        if self.cut:
            from tokenizers.pre_tokenizers import ByteLevel

            spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
            self.spelling = {k: spell(chr(k))[0][0] for k in range(128, 256) if PLAIN.match(chr(k))}
        self.numbers = _Numbers()
        self.lengths = np.array([1], dtype=np.int64)  # entry 0 is the end of a document
        self.ids = np.array([self.end_id], dtype=np.uint32)
        self.seen = np.zeros(1, dtype=np.int32)

    def _forget(self) -> None:
        """Keeps the words that came more than once, at most half of what may be kept: the most frequent ones."""
        words, often = list(self.numbers), self.seen[1:]  # in the order of their numbers
        kept = np.flatnonzero(often > 1)
        if len(kept) > self.most_words // 2:
            kept = np.sort(kept[np.argsort(-often[kept], kind="stable")[: self.most_words // 2]])
        starts, place = np.cumsum(self.lengths) - self.lengths, np.append(0, kept + 1)
        self.seen, self.lengths = (self.seen[place] + 1) // 2, self.lengths[place]  # what was frequent long ago goes in time
        ends = np.cumsum(self.lengths)
        self.ids = self.ids[np.repeat(starts[place] - (ends - self.lengths), self.lengths) + np.arange(ends[-1])]
        self.numbers = _Numbers()
        self.numbers.update((words[k], n) for n, k in enumerate(kept.tolist(), 1))

    def _forms(self, words: list[bytes]) -> list[bytes]:
        """The words as they are looked up."""
        if not self.fold or not words:
            return words
        folded = b" ".join(words).lower()  # bytes: A-Z only
        if any(x in folded for x in self.added):
            return words
        return [f if f.isascii() else w for f, w in zip(folded.split(b" "), words)]

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids, by the whole tokenizer; words go through it a few dozen at a time."""
        if self.border is None or any(self.border in w for w in words):
            coded = [c.ids for c in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            return np.array([len(c) for c in coded], np.int64), np.array([i for c in coded for i in c], np.uint32)
        runs = [self.border.join([*words[i : i + 64], ""]) for i in range(0, len(words), 64)]
        flat = np.concatenate([np.array(c.ids, np.uint32) for c in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)])
        border = flat == self.border_id
        return np.diff(np.flatnonzero(border), prepend=-1) - 1, flat[~border]

    def _by_pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same, by the model where a word is plain."""
        text = " ".join(words).encode()
        if self.cut is None or any(x in text or x in text.lower() for x in self.added):
            return self._ids(words)
        model, pieces, plain = self.tokenizer.model.tokenize, self.cut.findall, PLAIN.fullmatch
        known: dict[str, list[int]] = {}

        def ids(piece: str) -> list[int]:
            if (found := known.get(piece)) is None:
                spelt = piece if piece.isascii() else piece.translate(self.spelling)
                found = known[piece] = [token.id for token in model(spelt)]
            return found

        coded, others = [], []
        for k, word in enumerate(words):
            if plain(word):
                parts = pieces(word.lower() if self.fold else word)
                coded.append(ids(parts[0]) if len(parts) == 1 else [i for part in parts for i in ids(part)])
            else:
                others.append(k)
                coded.append([])
        if others:
            lengths, flat = self._ids([words[k] for k in others])
            for k, some in zip(others, np.split(flat, np.cumsum(lengths)[:-1])):
                coded[k] = some.tolist()
        return np.fromiter(map(len, coded), np.int64, len(coded)), np.fromiter(chain.from_iterable(coded), np.uint32)

    def _learn(self, words: list[bytes]) -> None:
        parts = [self._by_pieces([w.decode() for w in words[low : low + 8192]]) for low in range(0, len(words), 8192)]
        self.lengths = np.concatenate([self.lengths, *(lengths for lengths, _ in parts)])
        self.ids = np.concatenate([self.ids, *(ids for _, ids in parts)])
        self.seen = np.append(self.seen, np.zeros(len(words), np.int32))

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of ids of each text. Arrow splits the texts and
        tells their different words, so that Python looks each of these up once a call."""
        if len(self.numbers) > self.most_words:
            self._forget()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = self._forms(coded.dictionary.cast(pa.large_binary()).to_pylist())
        number = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        self._learn(self.numbers.new)
        self.numbers.new = []
        places, real = coded.indices.to_numpy(), number > 0
        often = np.bincount(places, minlength=len(words))
        self.seen += np.bincount(number[real], often[real], len(self.seen)).astype(np.int32)
        in_text = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.insert(number[places], np.cumsum(in_text), 0)
        lengths = np.where(order < 0, 0, self.lengths[order])
        starts = (np.cumsum(self.lengths) - self.lengths)[order]
        ends = np.cumsum(lengths)
        ids = self.ids[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]
        last = np.cumsum(in_text + 1) - 1
        return ids, np.diff(ends[last], prepend=0)


class TokenFileWriter:
    def __init__(self, sink, frame_bytes: int = FRAME_BYTES, level: int = 1):
        self.sink, self.frame_bytes = sink, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.table: list[tuple[int, int, int]] = []
        self.pending: list[bytes] = []
        self.size = 0
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        data = ids.astype("<u4", copy=False).tobytes()
        if self.size + len(data) > self.frame_bytes:
            self._flush()
        while len(data) > self.frame_bytes:
            self._frame(data[: self.frame_bytes])
            data = data[self.frame_bytes :]
        self.pending.append(data)
        self.size += len(data)

    def _flush(self) -> None:
        if self.size:
            self._frame(b"".join(self.pending))
        self.pending, self.size = [], 0

    def _frame(self, data: bytes) -> None:
        packed = self.compressor.compress(data)
        self.sink.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        self._flush()
        n = len(self.doc_ids)
        index = (np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes()
                 + np.array([d is not None for d in self.doc_ids], "u1").tobytes() + np.array(self.counts, "<i8").tobytes())
        packed = struct.pack("<Q", n) + self.compressor.compress(index)
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(packed)) + packed)
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_TABLE, len(entries) + len(footer)) + entries + footer)


class TokenFile:
    """Random access to one file; only the frames asked for are fetched and decompressed."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        footer = source.read_at(9, size - 9)
        frames, flags, magic = struct.unpack("<IBI", footer)
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a token file: no seek table with checksums at its end")
        table_at = size - 9 - 12 * frames - 8
        table = np.frombuffer(source.read_at(12 * frames, table_at + 8), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.sizes, self.checksums = table[:, 0], table[:, 1], table[:, 2]
        self.places = np.cumsum(self.packed) - self.packed
        self.ends = np.cumsum(self.sizes)
        index_at = int(self.packed.sum())
        raw = source.read_at(table_at - index_at, index_at)
        n = struct.unpack("<Q", raw[8:16])[0]
        self.decompressor = zstandard.ZstdDecompressor()
        index = self.decompressor.decompress(raw[16:], max_output_size=17 * n) if n else b""
        self.doc_ids = np.frombuffer(index, "<i8", n)
        self.present = np.frombuffer(index, "u1", n, 8 * n).astype(bool)
        self.counts = np.frombuffer(index, "<i8", n, 9 * n)
        self.starts = np.cumsum(self.counts) - self.counts
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._last[0] != k:
            packed = self.source.read_at(int(self.packed[k]), int(self.places[k]))
            data = self.decompressor.decompress(packed, max_output_size=int(self.sizes[k]))
            if len(data) != self.sizes[k] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checksums[k]:
                raise ValueError(f"frame {k} is damaged")
            self._last = (k, data)
        return self._last[1]

    def document(self, number: int) -> bytes:
        """Ids of the file's n-th document as little-endian 32-bit integers."""
        low = 4 * int(self.starts[number])
        high = low + 4 * int(self.counts[number])
        k, parts = int(np.searchsorted(self.ends, low, side="right")), []
        while low < high:
            begin = int(self.ends[k] - self.sizes[k])
            stop = min(high, int(self.ends[k]))
            parts.append(self.frame(k)[low - begin : stop - begin])
            low, k = stop, k + 1
        return b"".join(parts)


def _file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


MANIFEST = "file string, part int, first_id long, docs long, tokens long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES,
                      most_words: int | None = None) -> DataFrame:
    """Encode ``text`` of all rows, in ascending ``doc_id`` order, into token files under ``folder`` (a URI that all
    executors reach, of a kind that Arrow opens: file, hdfs, s3, gs).

    Rows are range-partitioned and sorted by doc_id (null first), then the text's hash and the text; ranges hold about
    ``file_bytes`` of text, also where many rows share an id or have none. Each task writes one file, under a name of its own, so that a repeated attempt never touches another's file. The manifest (``folder/manifest``, Parquet) names
    the files that count and is returned: file, part (their order), first_id, docs, tokens. Null and empty texts are documents of the end
    id alone; repeated ids and rows are all written. Other columns are not read. No rows give an empty manifest.
    ``most_words``: words whose ids a worker keeps (``CACHED_WORDS``); fewer take less memory and more time.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    whole = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = ["doc_id", "text_hash", "text"]
    ordered = rows.repartitionByRange(max(1, -(-whole // file_bytes)), *order[:2]).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        encoder = word_encoder(tokenizer, end_id, most_words)
        name, sink, writer = f"tokens-{uuid.uuid4().hex}.zst", None, None
        for batch in batches:
            for part in slices(batch):
                if writer is None:
                    system.create_dir(base, recursive=True)
                    sink = system.open_output_stream(f"{base}/{name}", compression=None)
                    writer = TokenFileWriter(sink, frame_bytes)
                ids, counts = encoder.encode(part.column("text"))
                at = 0
                for doc_id, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                    writer.add(doc_id, ids[at : at + n])
                    at += n
        if writer is not None:
            writer.close()
            sink.close()
            first = next((d for d in writer.doc_ids if d is not None), None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first], pa.int64()), pa.array([len(writer.counts)], pa.int64()),
                 pa.array([sum(writer.counts)], pa.int64())], names=["file", "part", "first_id", "docs", "tokens"])

    spark = docs.sparkSession
    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return token_manifest(spark, folder)


def token_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str, only: Iterable[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary) of all documents, or of those with the given ids.

    ``start`` counts the ids of all documents before, over all files in their order. Files are read by as many tasks as
    there are files; with ``only``, files and frames without such documents are not fetched.
    """
    manifest = token_manifest(spark, folder)
    order = ["part"]  # ranges of ids rise with it; several files may begin with the same id
    before = F.sum("tokens").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    # one row per file; bounds of the ids in a file come from its neighbour
    until = F.lead("first_id").over(Window.orderBy(*order))
    files = manifest.select("file", "first_id", F.coalesce(before, F.lit(0)).alias("base"), until.alias("until"))
    wanted = None if only is None else np.array(sorted(set(only)), np.int64)

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Files between whose bounds any wanted id lies; those without ids before the first have no lower bound."""
        for batch in batches:
            first, until = (batch.column(c) for c in ("first_id", "until"))
            low = np.where(first.is_valid(), np.searchsorted(wanted, first.fill_null(0).to_numpy()), 0)
            high = np.where(until.is_valid(), np.searchsorted(wanted, until.fill_null(0).to_numpy(), side="right"), len(wanted))
            yield batch.filter(pa.array(high > low))

    if wanted is not None:
        files = files.mapInArrow(holding, files.schema)
    number = max(1, manifest.count())
    files = files.repartition(number, "file").select("file", "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        for batch in batches:
            for name, offset in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                with system.open_input_file(f"{base}/{name}") as source:
                    tokens = TokenFile(source)
                    chosen = np.arange(len(tokens.counts))
                    if wanted is not None:
                        chosen = chosen[np.isin(tokens.doc_ids, wanted) & tokens.present]
                    for low in range(0, len(chosen), 256):
                        some = chosen[low : low + 256]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(tokens.doc_ids[some], mask=~tokens.present[some]), pa.array(tokens.starts[some] + offset),
                             pa.array(tokens.counts[some]), pa.array([tokens.document(int(i)) for i in some], pa.binary())],
                            names=["doc_id", "start", "n_tokens", "ids"])

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


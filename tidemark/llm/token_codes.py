"""Token ids as directly addressable codes in binary files.

File format (little endian). ``DAC1``, the length of a JSON header as uint32, the header, then the parts it
names at offsets from the start of the data: ``doc_ids`` int64 and ``starts`` uint64 (first token of each
document in the file, and the total), then for each level ``chunks`` (one byte for each value that reaches the
level), ``more`` (a bit for each: it goes on in the next level) and ``ranks`` (uint32: set bits before each
block of 512). Level 0 holds the low eight bits of every id. The value at position i continues at the position in
the next level that equals the number of set bits before it, which one directory entry and at most 64 bytes of
bitmap give: any token is read without decoding its neighbours.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from string import ascii_letters, punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ready, written
from tidemark.llm.words import WHITE, text_slices
from tidemark.session import fresh_dir

MAGIC = b"DAC1"
RANK_BLOCK = 512
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Tokens after which a task begins another file (a longer document still lies in one).
FILE_TOKENS = 4 << 20
#: Distinct words whose ids a worker remembers, and the bytes of the longest of them.
KNOWN_WORDS = 300_000
LONG_WORD = 64
#: Bytes of text encoded at a time.
TEXT_BYTES = 2 << 20
#: ASCII punctuation and letters.
MARK, LETTER = (np.isin(np.arange(256), list(chars.encode())) for chars in (punctuation, ascii_letters))

MANIFEST = "file string, first_doc long, n_docs long, n_tokens long"


# ------------------------------------------------------------------ the code


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, rank directory) of each level for ids of 32 bits."""
    rest, levels = ids.astype(np.uint32, copy=False), []
    while True:
        chunks = rest.astype(np.uint8)
        rest = rest >> np.uint32(8)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), RANK_BLOCK)))]) if len(more) else np.zeros(1)
        levels.append((chunks, bits, ranks[: max(1, -(-len(more) // RANK_BLOCK))].astype(np.uint32)))
        if not more.any():
            return levels
        rest = rest[more]


def decode_levels(levels: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """All ids from (chunks, bitmap) of each level."""
    ids = np.zeros(0, np.uint32)
    for chunks, bits in reversed(levels):
        more = np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)
        own = chunks.astype(np.uint32)
        own[more] |= ids << np.uint32(8)
        ids = own
    return ids


def file_bytes(doc_ids: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> bytes:
    parts = [("doc_ids", doc_ids.astype("<i8")), ("starts", starts.astype("<u8"))]
    for k, (chunks, bits, ranks) in enumerate(encode_levels(ids)):
        parts += [(f"chunks{k}", chunks), (f"more{k}", bits), (f"ranks{k}", ranks.astype("<u4"))]
    at, places = 0, {}
    for name, part in parts:
        places[name] = [at, part.nbytes]
        at += part.nbytes
    header = json.dumps({"n_docs": len(doc_ids), "n_tokens": len(ids), "parts": places}).encode()
    return MAGIC + struct.pack("<I", len(header)) + header + b"".join(part.tobytes() for _, part in parts)


class TokenFile:
    """Random access to one file: only the bytes that a question needs are read."""

    def __init__(self, source):
        self.source = source
        head = self._bytes(0, 8)
        if head[:4] != MAGIC:
            raise ValueError("not a token file")
        size = struct.unpack("<I", head[4:])[0]
        self.header = json.loads(self._bytes(8, size))
        self.base = 8 + size
        self.n_docs, self.n_tokens = self.header["n_docs"], self.header["n_tokens"]

    def _bytes(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def part(self, name: str, kind, first: int = 0, count: int | None = None) -> np.ndarray:
        at, size = self.header["parts"][name]
        width = np.dtype(kind).itemsize
        count = size // width - first if count is None else min(count, size // width - first)
        return np.frombuffer(self._bytes(self.base + at + first * width, count * width), kind)

    def token(self, i: int) -> int:
        """The id at position ``i`` of the file."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, level = 0, 0
        while True:
            value |= int(self.part(f"chunks{level}", np.uint8, i, 1)[0]) << (8 * level)
            block = i // RANK_BLOCK
            bits = np.unpackbits(self.part(f"more{level}", np.uint8, block * RANK_BLOCK // 8, RANK_BLOCK // 8), bitorder="little")
            if not bits[i % RANK_BLOCK]:
                return value
            i = int(self.part(f"ranks{level}", "<u4", block, 1)[0]) + int(bits[: i % RANK_BLOCK].sum())
            level += 1

    def tokens(self) -> np.ndarray:
        levels = sum(name.startswith("chunks") for name in self.header["parts"])
        return decode_levels([(self.part(f"chunks{k}", np.uint8), self.part(f"more{k}", np.uint8)) for k in range(levels)])

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        return self.part("doc_ids", "<i8"), self.part("starts", "<u8").astype(np.int64)


# ------------------------------------------------------------------ text to ids


class WordEncoder:
    """Ids of texts by a tokenizer that never joins characters across ASCII white space.

    Each distinct word of a slice is encoded once and remembered; the ids of a text are those of its words in
    turn. New words are encoded many at a time. One of letters alone is nearly always one piece, and the last token of a
    piece alone has the suffix of word ends: such words stand with a space between them, and their ids fall apart at
    the ends. Groups with more ends than words, and words of other characters, get a word of one control
    character between them, whose id no other text has.

    Words and ids are held in Arrow and numpy arrays. Of more than ``known_words`` the half seen most often is kept, and
    words of more than ``LONG_WORD`` bytes are not remembered, so that what a worker holds is bounded for all texts.
    ``tests`` hold this against the tokenizer applied to whole texts.
    """

    BETWEEN = "\x01"
    AT_A_TIME = 400
    #: A tokenizer with these pieces tells a mark from the ASCII letter before it, whatever stands around.
    PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

    def __init__(self, tokenizer_json: str, known_words: int = KNOWN_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.known_words = known_words
        between = self.tokenizer.encode(self.BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else None
        self.cuts_marks = json.dumps(self.PIECES) in json.dumps(json.loads(tokenizer_json)["pre_tokenizer"])
        self.last = self._word_ends(getattr(self.tokenizer.model, "end_of_word_suffix", None))
        self.words = pa.array([], pa.binary())
        self.first = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.seen = np.zeros(0, np.int64)

    def _word_ends(self, suffix: str | None) -> np.ndarray | None:
        """Whether each id ends a piece; None unless every byte may end one, so that no piece is without an end."""
        vocab = self.tokenizer.get_vocab()
        if not suffix or sum(len(t) == len(suffix) + 1 and t.endswith(suffix) for t in vocab) != 256:
            return None
        last = np.zeros(max(vocab.values()) + 1, bool)
        last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        return last

    def _batches(self, words: list[str], between: str) -> Iterator[tuple[list[str], np.ndarray]]:
        """(words, their ids) for so many words at a time, each with ``between`` behind it."""
        groups = [words[i : i + self.AT_A_TIME] for i in range(0, len(words), self.AT_A_TIME)]
        texts = [between.join(group) + between for group in groups]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            yield group, np.array(e.ids, np.uint32)

    def _apart(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids of words in turn, number of ids of each) for runs of words of any kind."""
        if self.between is None or any(self.BETWEEN in w for w in words):
            ids = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
            yield np.fromiter((i for x in ids for i in x), np.uint32), np.array([len(x) for x in ids], np.int64)
            return
        for _, flat in self._batches(words, f" {self.BETWEEN} "):
            marks = np.flatnonzero(flat == self.between)
            yield np.delete(flat, marks), np.diff(marks, prepend=-1) - 1

    def _joined(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for words of letters alone, which are one piece or more."""
        for group, flat in self._batches(words, " "):
            ends = np.flatnonzero(self.last[flat])
            if len(ends) == len(group):
                yield flat, np.diff(ends, prepend=-1)
            else:
                yield from self._apart(group)

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Remember words; the order in which they were taken."""
        texts = [w.decode("utf-8", "replace") for w in new.to_pylist()]
        plain = np.fromiter(map(str.isalpha, texts), bool, len(texts)) & (self.last is not None)
        joined, apart = np.flatnonzero(plain), np.flatnonzero(~plain)
        parts = [*self._joined([texts[i] for i in joined]), *self._apart([texts[i] for i in apart])]
        order = np.concatenate([joined, apart])
        self.words = pa.concat_arrays([self.words, new.take(pa.array(order))])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate([n for _, n in parts]))])
        self.flat = np.concatenate([self.flat, *[ids for ids, _ in parts]])
        self.seen = np.concatenate([self.seen, np.zeros(len(order), np.int64)])
        return order

    def _forget(self) -> None:
        """Keep the short words, and of too many the half seen most often."""
        counts = np.diff(self.first)
        inside = pc.less_equal(pc.binary_length(self.words), LONG_WORD).to_numpy(zero_copy_only=False)
        if inside.sum() > self.known_words:
            order = np.argsort(np.where(inside, -self.seen, 1), kind="stable")
            inside[order[self.known_words // 2 :]] = False
            self.seen //= 2
        if not inside.all():
            self.words = self.words.filter(pa.array(inside))
            self.flat = self.flat[np.repeat(inside, counts)]
            self.first = np.concatenate([[0], np.cumsum(counts[inside])])
            self.seen = self.seen[inside]

    def encode(self, words) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in turn, number of ids of each word). ``words``: a list of bytes or an Arrow array of them."""
        coded = pa.array(words, pa.binary()).dictionary_encode()
        distinct, at = coded.dictionary, coded.indices.to_numpy()
        place = pc.fill_null(pc.index_in(distinct, self.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            known = len(self.words)
            place[new[self._learn(distinct.take(pa.array(new)))]] = known + np.arange(len(new))
        self.seen[place] += np.bincount(at, minlength=len(distinct))
        first = self.first[place]
        counts = (self.first[place + 1] - first)[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(first[at] - (ends - counts), counts) + np.arange(total)]
        if len(new):
            self._forget()
        return ids, counts


_encoders: dict[int, WordEncoder] = {}


def worker_encoder(tokenizer_json: str) -> WordEncoder:
    """The encoder of this Python worker, which serves its tasks one after another."""
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(tokenizer_json)
    return _encoders[key]


def encode_texts(encoder: WordEncoder, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, each closed by ``end_id``; number of ids of each text)."""
    raw, texts, whole = data.tobytes(), [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        text = raw[a:b]
        # The tokenizer lower-cases anyway; for plain ASCII the order of its steps does not matter, and there are fewer
        # distinct words. Its special tokens are told by case, so texts that may hold one stay as they are.
        if b"<|" in text:
            whole.append((a, b))
        elif text.isascii():
            text = text.lower()
        texts.append(text)
    data = np.frombuffer(b"".join(texts), np.uint8)
    inside = ~WHITE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if encoder.cuts_marks:
        marks = MARK[data]
        marks[1:] &= LETTER[data[:-1]]
        for a, b in whole:
            marks[a:b] = False
        begins |= marks
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    sizes = np.diff(np.searchsorted(np.flatnonzero(begins), offsets))
    kept = data[inside]
    bounds = np.append(np.flatnonzero(begins[inside]), len(kept)).astype(np.int32)
    ids, counts = encoder.encode(pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(kept)]))
    ends = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(sizes)]
    return np.insert(ids, ends, end_id), np.diff(ends, prepend=0) + 1


# ------------------------------------------------------------------ Spark jobs


def _open(path: str):
    """The file system and path of a URI or a plain local path."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of some batches at a time, of about ``TEXT_BYTES``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= TEXT_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def write_batches(batches: Iterator[pa.RecordBatch], folder: str, tokenizer_json: str, end_id: int, file_tokens: int) -> Iterator[pa.RecordBatch]:
    """Write files for rows of doc_id, text in their order; rows of MANIFEST for the files.

    A file gets a name of its own and appears under it when it is whole, so that a repeated attempt of a task
    never touches the files of another one. What an attempt that is lost has left is in no manifest.
    """
    encoder = worker_encoder(tokenizer_json)
    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    docs, sizes, ids, held = [], [], [], 0

    def flush() -> pa.RecordBatch:
        names = np.concatenate(docs)
        starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        path = f"{base}/{uuid.uuid4().hex}.dac"
        with system.open_output_stream(f"{path}.part") as out:
            out.write(file_bytes(names, starts, np.concatenate(ids)))
        system.move(f"{path}.part", path)
        row = [f"{folder.rstrip('/')}/{path.rsplit('/', 1)[1]}", int(names[0]), len(names), int(starts[-1])]
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["file", "first_doc", "n_docs", "n_tokens"])

    for batch in together(batches):
        keys = batch.column(0).to_numpy()
        for a, b, data, offsets in text_slices(batch.column(1), TEXT_BYTES):
            part, lengths = encode_texts(encoder, data, offsets, end_id)
            docs.append(keys[a:b])
            sizes.append(lengths)
            ids.append(part)
            held += len(part)
            if held >= file_tokens:
                yield flush()
                docs, sizes, ids, held = [], [], [], 0
    if docs:
        yield flush()


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, file_tokens: int = FILE_TOKENS
) -> DataFrame:
    """Encode every text and write the ids of all documents, in ascending doc_id order, to files in ``folder``.

    Returns the manifest (file, first_doc, n_docs, n_tokens), written beside the files. ``tokenizer`` is the path
    of a tokenizer file on the driver. A null text is empty and gives the end id alone; rows without a doc_id
    are left out, rows that repeat one are kept, ordered by text. An empty table gives no file.
    """
    spark = ready(docs.sparkSession)
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    with open(tokenizer, encoding="utf-8") as source:
        model = spark.sparkContext.broadcast(source.read())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = texts.filter("doc_id IS NOT NULL").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        return write_batches(batches, folder, model.value, end_id, file_tokens)

    return written(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, start in the file, n_tokens and ids (little-endian uint32 bytes) from the files that rows name."""
    for batch in batches:
        for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            system, place = _open(path)
            with system.open_input_file(place) as source:
                opened = TokenFile(source)
                doc_ids, starts = opened.documents()
                raw = opened.tokens().astype("<u4", copy=False)
            crcs = [zlib.crc32(raw[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids), pa.array(starts[:-1] + base), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_digests(manifest: DataFrame) -> DataFrame:
    """Per document, read back from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The window runs over one row for each file.
    """
    before = Window.orderBy("first_doc", "file").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long").alias("base"))
    spread = placed.repartition(manifest.sparkSession.sparkContext.defaultParallelism, "file")
    return spread.mapInArrow(read_batches, "doc_id long, start long, n_tokens long, ids_crc32 long")


def random_token(manifest: DataFrame, position: int) -> int:
    """The id at a position of the whole corpus: one file, a few small reads."""
    before = Window.orderBy("first_doc", "file").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    row = manifest.withColumn("base", base).filter((F.col("base") <= position) & (F.col("base") + F.col("n_tokens") > position)).first()
    if row is None:
        raise IndexError(position)
    system, place = _open(row.file)
    with system.open_input_file(place) as source:
        return TokenFile(source).token(position - row.base)


def token_folder(spark: SparkSession) -> str:
    return fresh_dir(spark, "tokens")

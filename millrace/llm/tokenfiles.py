"""Token ids in Arrow files of fixed-size lists: equal-length sequences with masks.

A part of the corpus is two files in one folder: ``<part>.arrow`` holds the ids as record batches of
``sequence`` (fixed-size list of ids, in 16 bits where the vocabulary allows it, else in 32) and ``mask``
(fixed-size list of booleans, false on the padding of the last sequence); ``<part>.index.arrow`` says where each document starts. Both are
in the Arrow file format, so a reader maps them and gets at any sequence without copying.
"""

from __future__ import annotations

import os
import random
import re
import string
import uuid
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from millrace.workspace import cut_lineage, scratch_path

END_ID = 1
LENGTH = 2048
BATCH_ROWS = 512  # sequences per record batch
PART_BYTES = 32 << 20  # text bytes per part
CACHE = 600_000  # words whose ids a worker keeps
CHUNK = 4096  # new words given to the tokenizer at once
PROBES = 2000  # made-up words that show whether plain words may go to the model directly
TOGETHER = 4 << 20  # characters of text looked at together

# white space to Python that the tokenizers do not treat as such
ODD_SPACE = re.compile("[\x1c-\x1f]")
# letters of Latin-1, and a word of them with the ASCII marks that may stand behind it (no apostrophe)
LETTERS = string.ascii_letters + "".join(chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha())
MARKS = string.punctuation.replace("'", "")
PLAIN = re.compile(f"([{LETTERS}]+)([{re.escape(MARKS)}]*)")


class WordCachedTokenizer:
    """A tokenizer that drops white space and never joins text across it, with the ids of its words kept.

    For such a tokenizer the ids of a text are those of its words in turn, so each distinct word is
    encoded once. Words are what stands between white space. Words of Latin letters go to the
    tokenizer's model directly, past its patterns, if made-up words of all lengths show that these
    leave them whole and part them from marks behind them.
    """

    def __init__(self, path: str, end_id: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        largest = max([end_id, *self.tokenizer.get_vocab(with_added_tokens=True).values()])
        self.dtype = np.dtype("<u2" if largest < 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.plain = self._plain()

    def _encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def _plain(self):
        """How a word of letters reaches the model: lower-cased or not, as bytes or not; or (None) not directly."""
        from tokenizers import pre_tokenizers

        if any(set(t.content) <= set(LETTERS) or set(t.content) <= set(MARKS) for t in self.tokenizer.get_added_tokens_decoder().values()):
            return None
        r = random.Random(0)

        def some(of: str, n: int) -> str:
            return "".join(r.choice(of) for _ in range(n))

        probes = [(some(LETTERS if i % 2 else string.ascii_letters, 1 + i % 24), some(MARKS, max(0, i % 7 - 3))) for i in range(PROBES)]
        want = self._encode(" ".join(word + mark for word, mark in probes)).ids
        marks = [self._encode(mark).ids for _, mark in probes]
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        for table in ({ord(c): in_bytes.pre_tokenize_str(c)[0][0] for c in LETTERS}, {}):
            for way in (lambda w, t=table: w.lower().translate(t), lambda w, t=table: w.translate(t)):
                if [i for (word, _), mark in zip(probes, marks) for i in (*(t.id for t in self.model.tokenize(way(word))), *mark)] == want:
                    return way
        return None

    def _learn(self, new: list[str]) -> None:
        """Encode words: plain ones by the model, the others as one text whose tokens go to the word they start in."""
        if self.plain is not None:
            known, code = self.known, self.dtype.char
            words, others = [], []
            for word in new:
                found = PLAIN.fullmatch(word)
                if found is None:
                    others.append(word)
                else:
                    words.append((word, *found.groups()))
            for letters in {w for _, w, _ in words if w not in known}:
                known[letters] = array(code, [t.id for t in self.model.tokenize(self.plain(letters))]).tobytes()
            marks = {m: array(code, self._encode(m).ids).tobytes() for m in {m for _, _, m in words}}
            known.update((word, known[letters] + marks[mark]) for word, letters, mark in words if mark)
            new = others
        for at in range(0, len(new), CHUNK):
            part = new[at:at + CHUNK]
            found = self._encode(" ".join(part))
            ids = np.asarray(found.ids, self.dtype).tobytes()
            starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.offsets))
            lengths = np.fromiter(map(len, part), np.int64, len(part)) + 1
            cuts = np.searchsorted(starts, np.cumsum(lengths) - lengths) * self.dtype.itemsize
            cuts = [*cuts.tolist(), len(ids)]
            self.known.update((w, ids[cuts[i]:cuts[i + 1]]) for i, w in enumerate(part))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of each text."""
        listed = [None if ODD_SPACE.search(t) else t.split() for t in texts]
        seen = set().union(*(words for words in listed if words))
        new = [w for w in seen if w not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = list(seen)
        self._learn(new)
        find = self.known.__getitem__
        return [b"".join(map(find, words)) if words is not None else np.asarray(self._encode(t).ids, self.dtype).tobytes() for t, words in zip(texts, listed)]


_tokenizers: dict[tuple, WordCachedTokenizer] = {}


def _tokenizer(path: str, end_id: int) -> WordCachedTokenizer:
    if (path, end_id) not in _tokenizers:
        _tokenizers[path, end_id] = WordCachedTokenizer(path, end_id)
    return _tokenizers[path, end_id]


def _together(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts of a batch in stretches of bounded length."""
    ids, texts, size = [], [], 0
    for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
        ids.append(doc_id)
        texts.append(value.as_py())
        size += len(texts[-1])
        if size > TOGETHER:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _schema(length: int, dtype: np.dtype) -> pa.Schema:
    return pa.schema([("sequence", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class PartWriter:
    """Writes one part; a part appears under its name only when it is complete."""

    def __init__(self, folder: str, name: str, length: int = LENGTH, dtype: np.dtype = np.dtype("<u4")):
        self.store, root = fs.FileSystem.from_uri(folder)
        self.store.create_dir(root, recursive=True)
        self.length, self.dtype, self.final = length, dtype, f"{root}/{name}"
        self.draft = f"{root}/.{name}-{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.draft + ".arrow")
        self.writer = pa.ipc.new_file(self.out, _schema(length, dtype))
        self.index: list[tuple[int | None, int, int]] = []
        self.held: list[bytes] = []
        self.held_bytes = self.total = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.index.append((doc_id, self.total, n))
        self.total += n
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= self.dtype.itemsize * self.length * BATCH_ROWS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.held), self.dtype)
        step = self.length * BATCH_ROWS
        whole = len(flat) if last else len(flat) // self.length * self.length
        for at in range(0, whole, step):
            part = flat[at:min(at + step, whole)]
            rows = -(-len(part) // self.length)
            padded = np.zeros(rows * self.length, self.dtype)
            padded[:len(part)] = part
            mask = np.arange(len(padded)) < len(part)
            self.writer.write_batch(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(padded), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=_schema(self.length, self.dtype)))
        rest = flat[whole:].tobytes()
        self.held, self.held_bytes = [rest] if rest else [], len(rest)

    def close(self) -> None:
        self._flush(True)
        self.writer.close()
        self.out.close()
        ids, starts, lengths = zip(*self.index) if self.index else ((), (), ())
        with self.store.open_output_stream(self.draft + ".index.arrow") as out, pa.ipc.new_file(out, INDEX) as writer:
            writer.write_batch(pa.record_batch([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())], schema=INDEX))
        for end in (".arrow", ".index.arrow"):  # a repeated task writes the same content
            self.store.move(self.draft + end, self.final + end)


class PartReader:
    """Random access to one part; local files are mapped."""

    def __init__(self, folder: str, name: str):
        store, root = fs.FileSystem.from_uri(folder)
        opened = (lambda p: pa.memory_map(p)) if isinstance(store, fs.LocalFileSystem) else store.open_input_file
        self.file = pa.ipc.open_file(opened(f"{root}/{name}.arrow"))
        self.index = pa.ipc.open_file(opened(f"{root}/{name}.index.arrow")).read_all()
        self.length = self.file.schema.field("sequence").type.list_size
        sizes = [self.file.get_batch(i).num_rows for i in range(self.file.num_record_batches)]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self._at, self._ids = -1, None

    def _batch(self, number: int) -> np.ndarray:
        if number != self._at:
            batch = self.file.get_batch(number)
            self._at, self._ids = number, batch.column(0).flatten().to_numpy()
        return self._ids

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """One sequence and its mask."""
        number = int(np.searchsorted(self.first, row, "right")) - 1
        batch = self.file.get_batch(number)
        at = (row - int(self.first[number])) * self.length
        return (self._batch(number)[at:at + self.length],
                np.asarray(batch.column(1).flatten())[at:at + self.length])

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start`` of the part."""
        parts = []
        while n > 0:
            number = int(np.searchsorted(self.first, start // self.length, "right")) - 1
            at = start - int(self.first[number]) * self.length
            piece = self._batch(number)[at:at + n]
            parts.append(piece)
            start, n = start + len(piece), n - len(piece)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                      end_id: int = END_ID) -> DataFrame:
    """Encode every whole text in ascending key order into part files: (part, start, n_tokens) per part.

    ``tokenizer`` is the path of a tokenizers file that every executor can read; it must drop white
    space. ``folder`` is a shared folder. Documents are dealt to parts by ranges of the key, found on the
    keys alone; texts are encoded where they are read, and only ids travel. ``start`` counts the ids of
    all earlier parts. Ids of a document are those of its text (null: none) and ``end_id``. Rows with one
    key follow each other by their ids, null keys come first. An empty table writes no part. Other columns
    do not matter.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64).alias("bytes"), F.min("doc_id").alias("low")).first()
    parts = max(1, -(-(size["bytes"] or 0) // PART_BYTES))
    borders = []
    if parts > 1 and size["low"] is not None:
        shares = [i / parts for i in range(1, parts)]
        found = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * parts)).alias("at")).first()["at"]
        borders = sorted(set(found))  # at most one number per part

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(tokenizer, end_id)
        end = np.array([end_id], words.dtype).tobytes()
        for batch in batches:
            for keys, texts in _together(batch):
                part = [0 if k is None else 1 + bisect_left(borders, k) for k in keys]
                ids = [found + end for found in words.ids(texts)]
                yield pa.record_batch([pa.array(part, pa.int32()), pa.array(keys, pa.int64()), pa.array(ids, pa.binary())], ["range", "doc_id", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = _tokenizer(tokenizer, end_id).dtype
        writer = now = name = None

        def done() -> pa.RecordBatch:
            writer.close()
            return pa.record_batch([pa.array([name]), pa.array([writer.index[0][0]], pa.int64()), pa.array([writer.total], pa.int64())], ["part", "first", "n_tokens"])

        for batch in batches:
            for at, doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("range", "doc_id")), batch.column("ids")):
                if at != now:
                    if writer is not None:
                        yield done()
                    now, name = at, f"part-{'null' if doc_id is None else f'{doc_id + 2**63:020d}'}"
                    writer = PartWriter(folder, name, length, dtype)
                writer.add(doc_id, ids.as_py())
        if writer is not None:
            yield done()

    # ties of a key stay in one range, so parts begin with different keys
    encoded = rows.mapInArrow(encode, "range int, doc_id long, ids binary")
    dealt = encoded.repartition(parts, "range").sortWithinPartitions("range", F.col("doc_id").asc_nulls_first(), "ids")
    made = cut_lineage(dealt.mapInArrow(write, "part string, first long, n_tokens long"))
    before = Window.orderBy(F.col("first").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    return made.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"), "n_tokens")


def read_token_files(parts: DataFrame, folder: str) -> DataFrame:
    """Documents of part files, from the files alone: (doc_id, start, n_tokens, ids_crc32)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist()):
                reader = PartReader(folder, part)
                for some in reader.index.to_batches(max_chunksize=4096):
                    starts, lengths = some["start"].to_numpy(), some["n_tokens"].to_numpy()
                    sums = [zlib.crc32(reader.ids(int(s), int(n)).astype("<u4", copy=False)) for s, n in zip(starts, lengths)]
                    yield pa.record_batch([some["doc_id"], pa.array(starts + first), some["n_tokens"], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return parts.repartition(F.col("part")).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_folder(docs: DataFrame) -> str:
    """A new folder under the shared one, as a URI."""
    path = scratch_path(docs.sparkSession, "tokens")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"

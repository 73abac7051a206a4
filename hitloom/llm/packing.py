"""Pack documents into token sequences by power-of-two decomposition
(dataset decomposition, Pouransari et al. 2024).

A document of n tokens is cut into as many full sequences as it fills and the
binary digits of the rest, longest first.  Every piece is a sequence of its
own, so no sequence crosses documents and none is padded; sequences of equal
length form a bucket and are numbered together.

Tokens come from a tokenizer file.  A byte-level tokenizer splits text before
it merges, and a space between two other characters that aren't white space
always starts a new split, as a line end there does; so does what follows a
line end, and an ASCII character behind an ASCII letter that is no letter.  The
texts of a batch are therefore cut at those places in one pass over their bytes,
each different piece is encoded once a batch, and a worker remembers the ids of
pieces up to a fixed number.  A text in which white space meets white space, or
that names a special token, is encoded whole; so is every text for other kinds
of tokenizers.

Defined results: a null text has the end token alone; repeated rows are packed
as often as they come; null ids are kept; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import string
import struct
import sys
import threading
import zlib
from collections.abc import Callable, Iterator
from types import ModuleType, SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, rank_within

LENGTH = 2048
END_TOKEN = 1
REMEMBERED = 300_000  # pieces of a generation, of which a worker remembers two; only speed and memory depend on it
BATCH_BYTES = 4_000_000  # texts that are cut at once; only speed and memory depend on it
FORGET_S = 5.0  # so long after a worker's last packing task it forgets its pieces, which other work then has room for
PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_lengths(tokens: int, length: int = LENGTH) -> list[int]:
    """Full sequences, then the binary digits of the rest from the highest (``length`` a power of two)."""
    whole, rest = divmod(tokens, length)
    return [length] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def _remembered(path: str) -> SimpleNamespace:
    """A worker's tokenizer and the pieces that it knows.  Spark reuses Python workers,
    so they are kept for its next tasks, in a module of the process."""
    from tokenizers import Tokenizer

    kept = sys.modules.setdefault("_token_pieces_of_worker", ModuleType("_token_pieces_of_worker")).__dict__
    if path not in kept:
        kept[path] = SimpleNamespace(tokenizer=Tokenizer.from_file(path), recent={}, older={}, timer=None, lock=threading.Lock(), tasks=0)
    return kept[path]


def _begin(path: str) -> None:
    state = _remembered(path)
    with state.lock:
        state.tasks += 1
        if state.timer:
            state.timer.cancel()


def _end(path: str, seconds: float | None = None) -> None:
    """A task is done: without another one within ``seconds`` the worker's pieces go."""
    state = _remembered(path)

    def forget() -> None:
        with state.lock:
            if not state.tasks and threading.current_thread() is state.timer:
                state.recent, state.older = {}, {}

    with state.lock:
        state.tasks -= 1
        state.timer = threading.Timer(FORGET_S if seconds is None else seconds, forget)
        state.timer.daemon = True
        state.timer.start()


def ids_of_texts(path: str) -> Callable[[pa.Array], list[bytes | memoryview]]:
    """A function from texts (UTF-8 as large_binary, none null) to their ids as little-endian unsigned 32-bit numbers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on every core
    state = _remembered(path)
    tokenizer, words = state.tokenizer, state.tokenizer.model.tokenize
    setting = json.loads(tokenizer.to_str())
    splits_words = setting["normalizer"] is None and setting["pre_tokenizer"] == {
        "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    other_space = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace() and chr(i) not in " \n"]
    stops = ["  ", "\n\n", " \n", "\n ", *other_space, *special]
    # The printable character that stands for each byte.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in printable}
    shown |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    letter = np.array([chr(b) in string.ascii_letters for b in range(256)])
    other_ascii = ~letter & (np.arange(256) < 128)

    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def whole(text: str) -> bytes:
        return packed(tokenizer.encode(text, add_special_tokens=False).ids)

    def split(text: str) -> bytes:
        """Ids of letters, perhaps behind a space, which the tokenizer does not split further."""
        text = text.replace(" ", shown[32]) if text.isascii() else "".join(map(shown.__getitem__, text.encode()))
        return packed([t.id for t in words(text)])

    def found(piece: bytes) -> bytes:
        ids = state.recent.get(piece)
        if ids is None:
            ids = state.older.get(piece)
            if ids is None:
                ids = learnt(piece.decode())
            if len(state.recent) >= REMEMBERED:
                state.older, state.recent = state.recent, {}
            state.recent[piece] = ids
        return ids

    def learnt(piece: str) -> bytes:
        body = piece.removeprefix(" ")
        word = body.rstrip(string.punctuation)
        if not word.isalpha():
            return whole(piece)
        if len(word) == len(body):
            return split(piece)
        # Letters and a run of marks are splits of their own, a space goes to the letters.
        return found(piece[:len(word) - len(body)].encode()) + found(body[len(word):].encode())

    def by_pieces(texts: pa.Array) -> list[bytes | memoryview]:
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        if bounds[0] == bounds[-1]:
            return [b""] * len(texts)
        data, starts = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]
        # A piece keeps the space before it; a line end is a piece of its own.
        line_end = data == 10
        begins = line_end | (data == 32)
        begins[1:] |= line_end[:-1] | (letter[data[:-1]] & other_ascii[data[1:]])
        begins[starts[starts < len(data)]] = True
        at = np.flatnonzero(begins)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        different = coded.dictionary.to_pylist()
        ids = [found(p) if i is None else i for p, i in zip(different, map(state.recent.get, different))]
        encoded = pa.array(ids, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(encoded.buffers()[1], np.int64)[np.searchsorted(at, starts)].tolist()
        out = memoryview(encoded.buffers()[2])
        return [out[a:b] for a, b in zip(ends, ends[1:])]

    def run(texts: pa.Array) -> list[bytes | memoryview]:
        if not len(texts):
            return []
        strings = texts.cast(pa.large_string()).to_pylist()
        cuts = [splits_words and not (t[:1].isspace() or t[-1:].isspace() or any(s in t for s in stops)) for t in strings]
        if all(cuts):
            return by_pieces(texts)
        cut_texts = texts.filter(pa.array(cuts))
        encoded = iter(by_pieces(cut_texts) if len(cut_texts) else [])
        return [next(encoded) if c else whole(t) for c, t in zip(cuts, strings)]

    return run


def id_bytes(path: str) -> Callable[[str], bytes]:
    """``ids_of_texts`` for one text at a time."""
    ids_of = ids_of_texts(path)
    return lambda text: bytes(ids_of(pa.array([text.encode()], pa.large_binary()))[0])


def _parts(texts: pa.Array, size: int = BATCH_BYTES) -> list[tuple[int, int]]:
    """Bounds of runs of texts that have about ``size`` bytes together."""
    group = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // size
    at = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    return [(a, b) for a, b in zip(at, at[1:]) if a < b]


def token_pieces(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_token: int = END_TOKEN,
                 keep_ids: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) -> a row per piece: doc_id, start, length, ids_crc32, doc_tokens (and ids)."""
    path = tokenizer or default_tokenizer()
    end = np.array([end_token], "<u4").tobytes()
    id_type = docs.schema["doc_id"].dataType
    numbers = [f.split()[0] for f in PIECES.split(", ")]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(path)
        try:
            ids_of = ids_of_texts(path)
            for batch in batches:
                texts = pc.fill_null(batch["text"].cast(pa.large_binary()), b"")
                for first, last in _parts(texts):
                    rows, kept = [], []
                    for doc, ids in enumerate(ids_of(texts.slice(first, last - first)), first):
                        ids = b"".join((ids, end))
                        tokens, at = len(ids) // 4, 0
                        for n in piece_lengths(tokens, length):
                            own = ids[4 * at:4 * (at + n)]
                            rows.append((doc, at, n, zlib.crc32(own), tokens))
                            if keep_ids:
                                kept.append(np.frombuffer(own, "<u4"))
                            at += n
                    doc, *values = (pa.array(c, pa.int64()) for c in zip(*rows))
                    columns = {"doc_id": batch["doc_id"].take(doc), **dict(zip(numbers, values))}
                    yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(kept, pa.list_(pa.int64()))} if keep_ids else {}))
        finally:
            _end(path)

    schema = f"doc_id string, {PIECES}" + (", ids array<long>" if keep_ids else "")
    # doc_id travels as text, whatever its type.
    return (docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(pieces, schema)
            .withColumn("doc_id", F.col("doc_id").cast(id_type)))


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_token: int = END_TOKEN) -> DataFrame:
    """Pieces with sequence_id (gapless from 0 over all, shorter buckets first) and offset."""
    pieces = cut(token_pieces(docs, tokenizer, length, end_token), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row per power of two
    first, starts = 0, []
    for n in sorted(counts):
        starts.append((n, first))
        first += counts[n]
    begin = F.lit(0).cast("long")
    for n, at in starts:
        begin = F.when(F.col("length") == n, F.lit(at).cast("long")).otherwise(begin)
    ranked = rank_within(pieces, ["length"], ["doc_id", "start", "ids_crc32", "doc_tokens"], "_in_bucket")
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         (begin + F.col("_in_bucket")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

"""BPE encoding and decoding through tables of distinct words and distinct pieces.

Encoding. A block is a few megabytes of texts. Its texts become numbers into the list of its own
distinct words. The lists, cut by hash into fragments, meet in one task a fragment, where every
distinct word of the corpus is encoded once; its ids go back to each block that has it, and are
joined to the positions by the words' numbers. Frequent words cost one entry a block.

Decoding. A block's distinct ids are joined with the vocabulary's table of pieces, which is sent
to all executors as its size is the vocabulary's, and the pieces are put where the ids stand.

Nulls and empty texts have no tokens. Rows are never merged: repeated rows each get a result.
Columns other than the id and the text are ignored. The input is read twice and must give the
same rows in the same order each time, as files do; else the join fails, it never gives wrong ids.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.textbatch import Texts, release, slices

#: Fixed value: the pattern by which byte-level vocabularies of this kind part a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Text that a block covers; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: Text whose distinct words one fragment holds on average.
FRAGMENT_BYTES = 32 << 20
#: How hard packed numbers and words are compressed.
LEVEL = 6
#: Words encoded, and documents decoded, at a time.
BATCH_WORDS, BATCH_DOCS = 20_000, 1000
#: Runs of white space other than one space, one line break, or a line break and a space before a letter.
_RUNS = re.compile(r"\s{3}|[^\S\n]\s|\n[^\S ]|\s\s\Z|\x00")


def special_tokens(path: str) -> dict[str, int]:
    """Special strings of a vocabulary file and their ids."""
    with open(path, encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file).get("added_tokens", [])}


class Splitter:
    """Cuts texts into words, which are encoded each for itself; some may be empty."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        self.specials = special_tokens(path)
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None

    def split(self, text: str) -> list[str]:
        """Words of a text.

        Where white space is plain, a word is whatever lies between spaces, with the space before
        it, or a line break: the vocabulary's pattern cuts at these places in any case, so a word's
        ids do not depend on its neighbours. All else is cut by the pattern. A special string parts
        the text wherever it stands, even within a word.
        """
        if self.special and self.special.search(text):
            return list(chain.from_iterable([p] if p in self.specials else self._plain(p) for p in self.special.split(text)))
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if _RUNS.search(text):
            return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)]
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files of this kind."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """(id, piece bytes) of a vocabulary; bounded by the vocabulary."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    letters = byte_letters()
    rows = [(i, bytes(letters[c] for c in piece)) for piece, i in vocabulary.items()]
    known = {i for i, _ in rows}
    rows += [(i, s.encode()) for s, i in special_tokens(path).items() if i not in known]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["id", "piece"]), "id int, piece binary")


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers; for use inside tasks.

    Where a vocabulary numbers its pieces in the order of its merges, merging by the least number
    gives the same ids, and faster, so tiktoken does it; else, or where it gives up on a text, the
    tokenizers library does.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ranked = _ranked(path)

    def encode(self, text: str) -> bytes:
        if self.ranked is not None:
            try:
                return self.ranked.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            except (ValueError, RuntimeError):
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _ranked(path: str) -> tiktoken.Encoding | None:
    """The vocabulary as ranks, if the number of each merged piece follows the order of merges."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, letters = model["vocab"], byte_letters()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    numbers = [vocabulary.get("".join(m)) for m in merges]
    if model["type"] != "BPE" or None in numbers or numbers != sorted(set(numbers)) or len(vocabulary) != len(merges) + 256:
        return None
    ranks = {bytes(letters[c] for c in piece): i for piece, i in vocabulary.items()}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special_tokens(path))


def _pack(numbers: np.ndarray) -> bytes:
    """Small numbers of many documents, in bytes planes, which compress well."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes.tobytes())


def _unpack(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view("<u4")


def _pack_words(words: pa.Array) -> bytes:
    """Lengths, in byte planes, and letters of words: both compress better than Arrow's offsets."""
    texts = Texts.of(words)
    lengths = np.diff(texts.bounds).astype("<u4")
    planes = np.ascontiguousarray(lengths.view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=LEVEL).compress(np.uint32(len(lengths)).tobytes() + planes.tobytes() + texts.data.tobytes())


def _unpack_words(payload: bytes) -> pa.Array:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    planes = np.frombuffer(raw, np.uint8, 4 * n, 4)
    lengths = np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view("<u4")
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(raw[4 + 4 * n:]))


def _pack_lists(lists: pa.ListArray) -> bytes:
    """Lists of small numbers."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    return _pack(np.concatenate([[len(lengths)], lengths, lists.flatten().to_numpy(zero_copy_only=False)]).astype(np.uint32))


def _unpack_lists(payload: bytes) -> pa.ListArray:
    numbers = _unpack(payload)
    n = int(numbers[0])
    offsets = np.concatenate([[0], np.cumsum(numbers[1:n + 1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers[n + 1:]))


def _facts(ids: pa.Array, lengths: np.ndarray) -> np.ndarray:
    """Number of documents, lengths, which ids are known, ids: what stands before a block's numbers."""
    present = np.array(ids.is_valid(), np.uint32)
    keys = np.array(ids.fill_null(0), np.int64).view(np.uint32)
    return np.concatenate([[len(lengths)], lengths, present, keys]).astype(np.uint32)


def _open(payload: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Ids, lengths and numbers of the documents of a block."""
    numbers = _unpack(payload)
    n = int(numbers[0])
    lengths, present = numbers[1:n + 1].astype(np.int64), numbers[n + 1:2 * n + 1]
    keys = np.ascontiguousarray(numbers[2 * n + 1:4 * n + 1]).view(np.int64)
    return pa.array(keys, mask=present == 0), lengths, numbers[4 * n + 1:]


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _numbered(batches: Iterator[pa.RecordBatch], path: str, fragments: int) -> Iterator[tuple]:
    """For each block: its name, ids, lengths, words' numbers, distinct words by fragment, their numbers, fragments."""
    splitter = Splitter(path)
    task = TaskContext.get().partitionId()
    for n, batch in enumerate(slices(batches, "text", BLOCK_BYTES)):
        numbers, codes = _Numbers(), []
        for i in range(batch.num_rows):
            text = batch.column("text")[i].as_py()
            codes.append(np.fromiter(map(numbers.__getitem__, splitter.split(text)), np.uint32) if text else np.zeros(0, np.uint32))
        lengths = np.array([len(c) for c in codes], np.int64)
        distinct = pa.array(list(numbers), pa.string())
        texts = Texts.of(distinct)
        share = (texts.hashes(texts.bounds[:-1], texts.bounds[1:]) >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
        order = np.argsort(share, kind="stable")
        distinct = distinct.take(pa.array(order))
        mark = zlib.crc32(Texts.of(distinct).data)
        yield f"{task}-{n}-{mark}", batch.column("doc_id"), lengths, np.concatenate(codes), distinct, order, share[order].astype(np.int64)


def _words(batches: Iterator[pa.RecordBatch], path: str, fragments: int) -> Iterator[pa.RecordBatch]:
    for block, _, _, _, distinct, _, share in _numbered(batches, path, fragments):
        cuts = np.searchsorted(share, np.arange(fragments + 1))
        held = np.flatnonzero(np.diff(cuts))
        payloads = [_pack_words(distinct.slice(cuts[f], cuts[f + 1] - cuts[f])) for f in held]
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array([block] * len(held), pa.string()), pa.array(payloads, pa.binary())],
            ["fragment", "block", "payload"])


def _documents(batches: Iterator[pa.RecordBatch], path: str, fragments: int) -> Iterator[pa.RecordBatch]:
    for block, ids, lengths, numbers, distinct, order, _ in _numbered(batches, path, fragments):
        payload = _pack(np.concatenate([_facts(ids, lengths), [len(order)], order, numbers]).astype(np.uint32))
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([block], pa.string()), pa.array([payload], pa.binary())],
                                         ["fragment", "block", "payload"])


def _encode_fragment(table: pa.Table, path: str) -> pa.Table:
    """Encodes each distinct word of a fragment once; gives each block the ids of its words, in its order."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    parts = [_unpack_words(p) for p in table.column("payload").to_pylist()]
    coded = pa.concat_arrays(parts).dictionary_encode()
    flat, bounds = array("I"), array("i", [0])
    for start in range(0, len(coded.dictionary), BATCH_WORDS):
        for found in tokenizer.encode_batch(coded.dictionary.slice(start, BATCH_WORDS).to_pylist(), add_special_tokens=False):
            flat.extend(found.ids)
            bounds.append(len(flat))
    lists = pa.ListArray.from_arrays(pa.array(np.frombuffer(bounds, np.int32)), pa.array(np.frombuffer(flat, np.uint32)))
    payloads, start = [], 0
    for part in parts:
        mine = lists.take(coded.indices.slice(start, len(part)))
        start += len(part)
        payloads.append(_pack_lists(mine))
    del coded, lists, parts, tokenizer
    release()
    return pa.table({"fragment": table.column("fragment"), "block": table.column("block"), "payload": pa.array(payloads, pa.binary())})


def _join_back(key: tuple, words: pa.Table, documents: pa.Table) -> pa.Table:
    """The documents of a block, their words' numbers replaced by ids."""
    if len(documents) != 1:
        raise ValueError(f"block {key[0].as_py()} has {len(documents)} times its documents")
    payloads = documents.column("payload").to_pylist() + words.sort_by("fragment").column("payload").to_pylist()
    doc_ids, lengths, rest = _open(payloads[0])
    count = int(rest[0])
    order, numbers = rest[1:count + 1], rest[count + 1:]
    lists = pa.concat_arrays([_unpack_lists(p) for p in payloads[1:]]) if len(payloads) > 1 else pa.array([], pa.list_(pa.uint32()))
    if len(lists) != count:
        raise ValueError(f"block {key[0].as_py()} lost words")
    sizes, starts = np.zeros(count, np.int64), np.zeros(count, np.int64)
    sizes[order] = lists.value_lengths().to_numpy(zero_copy_only=False)
    starts[order] = np.cumsum(sizes[order]) - sizes[order]
    tokens = _gather(lists.flatten().to_numpy(), sizes, starts, numbers)
    ends = np.concatenate([[0], np.cumsum(sizes[numbers])])
    bounds = ends[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
    return pa.table({"doc_id": doc_ids, "ids": pa.ListArray.from_arrays(pa.array(bounds), pa.array(tokens.astype(np.int32)))})


def _gather(table: np.ndarray, sizes: np.ndarray, starts: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """Concatenation of the ranges that ``picks`` names, out of one flat table."""
    lengths = sizes[picks]
    if not len(lengths):
        return table[:0]
    ends = np.cumsum(lengths)
    shift = np.repeat(starts[picks] - (ends - lengths), lengths)
    return table[np.arange(int(ends[-1])) + shift]


def _encoded(docs: DataFrame, path: str, finish: Callable[[tuple, pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """What ``finish`` makes of each block's encoded words and documents."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    fragments = max(8, -(-size // FRAGMENT_BYTES))
    packed = "fragment int, block string, payload binary"
    words = rows.mapInArrow(lambda b: _words(b, path, fragments), packed)
    encoded = words.groupBy("fragment").applyInArrow(lambda t: _encode_fragment(t, path), packed)
    texts = rows.mapInArrow(lambda b: _documents(b, path, fragments), packed)
    # Each side has a stage of its own, so that a block has the same name in both.
    return encoded.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(finish, schema)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row, as the vocabulary file at ``path`` encodes its text."""
    return _encoded(docs, path, _join_back, "doc_id long, ids array<int>")


def _token_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each distinct id of a block, then a row of its documents, their ids renumbered."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_DOCS):
            rows = batch.slice(start, BATCH_DOCS)
            lists = pc.fill_null(rows.column("ids"), pa.scalar([], rows.column("ids").type))
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            distinct, numbers = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            payload = _pack(np.concatenate([_facts(rows.column("doc_id"), lengths), numbers]).astype(np.uint32))
            n = len(distinct)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*distinct.tolist(), None], pa.int32()), pa.array(range(n + 1), pa.int32()),
                 pa.array([None] * n + [payload], pa.binary())], ["id", "ordinal", "payload"])


_TOKEN_BLOCK = "id int, ordinal int, payload binary"


def _decoded(blocks: DataFrame, path: str, finish: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``finish`` makes of the decoded batches (doc_id, ids, text) of token blocks.

    The pieces come from a join on the id with the vocabulary's table, which every executor gets.
    The join keeps the order of rows within a partition, so that nothing is shuffled; each block
    checks that it has its pieces in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        pieces: list[bytes] = []
        for batch in batches:
            for i, ordinal, piece, payload in zip(*(batch.column(c).to_pylist() for c in ("id", "ordinal", "piece", "payload"))):
                if ordinal != len(ids):
                    raise ValueError("a block's pieces are out of order")
                if payload is None:
                    if piece is None:
                        raise ValueError(f"id {i} is not in the vocabulary")
                    ids.append(i)
                    pieces.append(piece)
                    continue
                doc_ids, lengths, numbers = _open(payload)
                sizes = np.array([len(p) for p in pieces], np.int64)
                letters = _gather(np.frombuffer(b"".join(pieces), np.uint8), sizes, np.cumsum(sizes) - sizes, numbers).tobytes()
                places = np.concatenate([[0], np.cumsum(lengths)])
                bounds = np.concatenate([[0], np.cumsum(sizes[numbers])])[places].tolist() if len(numbers) else [0] * len(places)
                texts = [letters[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:])]
                tokens = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(np.array(ids, np.int32)[numbers]))
                yield finish(pa.RecordBatch.from_arrays([doc_ids, tokens, pa.array(texts, pa.string())], ["doc_id", "ids", "text"]))
                ids, pieces = [], []
        release()

    joined = blocks.join(F.broadcast(piece_table(blocks.sparkSession, path)), "id", "left")
    return joined.select("id", "ordinal", "piece", "payload").mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of every row of (doc_id, ids); bytes that are no UTF-8 become U+FFFD.

    An id outside the vocabulary is an error.
    """
    blocks = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        _token_blocks, _TOKEN_BLOCK)
    return _decoded(blocks, path, lambda batch: batch, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, finish: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``finish`` makes of batches (doc_id, ids, text) of the texts encoded and decoded again.

    As ``decode(encode(docs))``, but a task of the last stage runs two Python functions one after
    the other, not four: each keeps a process and its memory.
    """

    def blocks(key: tuple, words: pa.Table, documents: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(_token_blocks(iter(_join_back(key, words, documents).combine_chunks().to_batches()))), pa.schema(
            [("id", pa.int32()), ("ordinal", pa.int32()), ("payload", pa.binary())]))

    return _decoded(_encoded(docs, path, blocks, _TOKEN_BLOCK), path, finish, schema)

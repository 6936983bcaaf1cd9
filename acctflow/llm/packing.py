"""Hierarchical multi-length packing of token sequences.

Every document becomes its token ids and one end id. A document is routed by
its length: whole windows of the longest context size are cut off at once, and
what remains (all of a short document) goes to the smallest context tier that
holds it. Each tier is packed from the longest down: a window opens with one
piece of its own tier, its gap takes the longest whole pieces of shorter tiers
that fit, and where none fits, the head of the shortest piece left fills the
gap exactly. So a window of every tier is full, and the tiers are powers of
two, which need no padding. Only the last window of a task can stay open; it
is cut at powers of two as well.

Windows of one tier form step groups of about equal cost (the sum of squared
piece lengths, which attention pays for): the windows of a flush are dealt in
order of cost to and fro over its groups.

Packing needs no shuffle and no key: a task packs the rows of its own
partition and holds at most ``flush_tokens`` ids beside one Arrow batch. A
repeated task reads the same rows in the same order and so gives the same
sequences. Sequence ids carry the partition's number in their upper bits.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctflow.llm import bpe
from acctflow.llm.common import BoundedCache, pieces, text_or_empty

SCHEMA = (
    "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "context int, step_group long, ids binary"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("context", pa.int32()), ("step_group", pa.int64()), ("ids", pa.binary())]
)


# Fixed by the byte-level files: how text is split before the merges.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# ``tiktoken`` backtracks over a run of white space and gives up at about a
# million characters, so runs from here on are split by hand.
LONG_SPACE = 100_000
_SPACES = regex.compile(r"\p{White_Space}{2,}+")


class ByteTokenizer:
    """Ids of a byte-level ``tokenizers`` file; the merges run in ``tiktoken``
    over the ranks that the file holds."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in enumerate(bpe.byte_alphabet())}
        ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self._words = tiktoken.Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._added = re.compile("|".join(re.escape(a) for a in sorted(self.added, key=len, reverse=True)))
        self.chunks = BoundedCache(self._chunk)

    def ids(self, text: str) -> bytes:
        if len(text) < LONG_SPACE:
            return array("I", self._words.encode_ordinary(text)).tobytes()
        out, at = array("I"), 0
        for m in _SPACES.finditer(text):
            if m.end() - m.start() < LONG_SPACE:
                continue
            # One word of the pattern: the run but for its last character, which
            # goes on with what follows, or all of it at the text's end.
            end = m.end() - (m.end() < len(text))
            out.extend(self._words.encode_ordinary(text[at : m.start()]))
            out.extend(self._words._core_bpe.encode_single_piece(text[m.start() : end].encode()))
            at = end
        out.extend(self._words.encode_ordinary(text[at:]))
        return out.tobytes()

    def _chunk(self, chunk: str) -> bytes | None:
        """Ids of a space and the chunk behind it. None where the chunk is
        empty or has white space at an end: there its neighbours matter."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        return self.ids(" " + chunk)

    def segments(self, text: str) -> Iterator[tuple[str, int]]:
        if not self.added or "<" not in text:
            yield text, -1
            return
        at = 0
        for m in self._added.finditer(text):
            yield text[at : m.start()], -1
            yield m[0], self.added[m[0]]
            at = m.end()
        yield text[at:], -1


@functools.lru_cache(maxsize=2)
def load(path: str) -> ByteTokenizer:
    """One tokenizer per file and Python worker."""
    return ByteTokenizer(path)


def document_ids(path: str, text: str, end_id: int) -> bytes:
    """The ids of ``text`` and the end id as little-endian unsigned 32 bits.

    A byte-level pattern never splits elsewhere before a space that stands
    between two other characters, so a text is taken chunk by chunk there;
    runs of white space take the whole stretch through the pattern instead.
    """
    tok = load(path)
    get = tok.chunks.__getitem__
    found: list[bytes] = []
    for part, added in tok.segments(text):
        if added >= 0:
            found.append(int(added).to_bytes(4, "little"))
            continue
        head, *chunks = part.split(" ")
        tail = chunks.pop() if chunks else None
        middle = list(map(get, chunks))
        if None in middle or tail is not None and (not head or head[-1].isspace() or not tail or tail[0].isspace()):
            found.append(tok.ids(part))
        else:
            found += [tok.ids(head), *middle]
            if tail is not None:
                found.append(tok.ids(" " + tail))
    found.append(int(end_id).to_bytes(4, "little"))
    return b"".join(found)


class Piece:
    __slots__ = ("doc", "start", "ids", "doc_tokens")

    def __init__(self, doc, start: int, ids: bytes, doc_tokens: int):
        self.doc, self.start, self.ids, self.doc_tokens = doc, start, ids, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) >> 2

    def split(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc, self.start, self.ids[: 4 * n], self.doc_tokens)
        return head, Piece(self.doc, self.start + n, self.ids[4 * n :], self.doc_tokens)


class Pool:
    """Pieces by length; a piece is taken by the longest length that fits."""

    def __init__(self, found: list[Piece]):
        self.by: dict[int, list[Piece]] = {}
        self.lengths: list[int] = []
        for p in sorted(found, key=len):
            self.put(p)

    def put(self, p: Piece) -> None:
        n = len(p)
        if n not in self.by:
            self.by[n] = []
            self.lengths.insert(bisect_right(self.lengths, n), n)
        self.by[n].append(p)

    def take(self, at: int) -> Piece:
        n = self.lengths[at]
        p = self.by[n].pop()
        if not self.by[n]:
            del self.by[n], self.lengths[at]
        return p

    def at_most(self, n: int) -> Piece | None:
        at = bisect_right(self.lengths, n) - 1
        return self.take(at) if at >= 0 else None

    def __bool__(self) -> bool:
        return bool(self.lengths)


def pack(found: list[Piece], tiers: list[int]) -> list[tuple[int, list[Piece]]]:
    """(context, pieces) of sequences over ``found``, each piece at most the
    longest tier. Every sequence is exactly as long as its context."""
    pool, out = Pool(found), []
    for at, tier in enumerate(tiers):
        floor = tiers[at + 1] if at + 1 < len(tiers) else 0
        while pool and pool.lengths[-1] > floor:
            window = [pool.take(len(pool.lengths) - 1)]
            gap = tier - len(window[0])
            while gap and pool:
                p = pool.at_most(gap)
                if p is None:
                    p, rest = pool.take(0).split(gap)
                    pool.put(rest)
                window.append(p)
                gap -= len(p)
            if not gap:
                out.append((tier, window))
                continue
            out += powers_of_two(window)
    return out


def powers_of_two(window: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """An open window as sequences whose lengths are powers of two."""
    left, out = sum(map(len, window)), []
    queue = list(window)
    while left:
        size = 1 << (left.bit_length() - 1)
        part, gap = [], size
        while gap:
            p = queue.pop(0)
            if len(p) > gap:
                p, rest = p.split(gap)
                queue.insert(0, rest)
            part.append(p)
            gap -= len(p)
        out.append((size, part))
        left -= size
    return out


def step_groups(sequences: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """A group number for each sequence: groups hold sequences of one context,
    about ``step_tokens`` tokens of them, and costs are dealt to and fro."""
    by: dict[int, list[int]] = {}
    for i, (context, _) in enumerate(sequences):
        by.setdefault(context, []).append(i)
    out, base = [0] * len(sequences), 0
    for context in sorted(by, reverse=True):
        members = sorted(by[context], key=lambda i: -sum(len(p) ** 2 for p in sequences[i][1]))
        n = max(1, -(-len(members) * context // step_tokens))
        for k, i in enumerate(members):
            lap, place = divmod(k, n)
            out[i] = base + (n - 1 - place if lap % 2 else place)
        base += n
    return out


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    context: int = 1024,
    tiers: int = 5,
    end_id: int = 0,
    step_tokens: int = 8192,
    flush_tokens: int = 4_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``id_col``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` (gapless in its sequence),
    ``context`` (the sequence's length), ``step_group`` and ``ids``
    (little-endian unsigned 32-bit ids of the piece).

    A null text is empty: its document is the end id alone. Repeated rows are
    documents of their own, a null id stays null, other columns are not read.
    An empty table gives an empty result.
    """
    sizes = [context >> k for k in range(tiers) if context >> k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        made, groups = 0, 0
        columns: list[list] = [[] for _ in _ARROW.names]
        held: list[Piece] = []
        waiting = 0

        def emit(sequences):
            nonlocal made, groups
            numbers = step_groups(sequences, step_tokens)
            for (size, window), g in zip(sequences, numbers):
                offset = 0
                for p in window:
                    row = (p.doc, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, base + made, offset, size)
                    for column, value in zip(columns, (*row, base + groups + g, p.ids)):
                        column.append(value)
                    offset += len(p)
                made += 1
            groups += max(numbers, default=-1) + 1

        def batch_out():
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
            )
            for c in columns:
                c.clear()
            return out

        for batch in pieces(batches):
            full: list[tuple[int, list[Piece]]] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = document_ids(tokenizer, text, end_id)
                whole = Piece(key, 0, ids, len(ids) >> 2)
                cut = len(whole) // context * context
                for at in range(0, cut, context):
                    full.append((context, [Piece(key, at, ids[4 * at : 4 * (at + context)], len(whole))]))
                if cut < len(whole):
                    held.append(Piece(key, cut, ids[4 * cut :], len(whole)))
                    waiting += len(held[-1])
            emit(full)
            if waiting >= flush_tokens:
                emit(pack(held, sizes))
                held, waiting = [], 0
            yield batch_out()
        if held:
            emit(pack(held, sizes))
            yield batch_out()

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return narrow.mapInArrow(run, SCHEMA).withColumnRenamed("id", id_col)

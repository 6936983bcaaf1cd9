"""BPE encoding by backtracking, decoding by an offset table.

The encoder scans a word with an Aho-Corasick automaton that holds every token
and remembers the longest token starting at each position. It then walks from
left to right, taking the longest match that is compatible with the token
before it. Two neighbouring tokens are compatible when merging their joined
text by merge priority leaves exactly these two tokens; a table of the merge
pairs and of each token's two halves answers that. Where no prefix of the match
is compatible, the walk steps back over the last token and marks the position
as a dead end, so every position is left at most once: the time is linear in
the word, and the ids are exactly those of merging pair by pair.

The decoder keeps the texts of all tokens in one buffer with an offset per
token; decoding gathers slices of it.

Vocabularies are read from a ``tokenizers`` JSON file; nothing is trained here.
Words repeat, so their ids are kept in a bounded memo per Python worker.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctflow.llm.common import BoundedCache, arrow_rows, pieces, text_or_empty


def byte_alphabet() -> list[str]:
    """The printable stand-in character of each byte value, as byte-level
    vocabularies write them: printable Latin-1 bytes stand for themselves, the
    others for U+0100 and on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0x100
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class OffsetTable:
    """All token texts in one UTF-8 buffer with an offset per token id."""

    def __init__(self, texts: list[bytes]):
        self.buffer = b"".join(texts)
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).tolist()

    def decode(self, ids, joined_by: bytes = b"") -> bytes:
        buffer, at = self.buffer, self.offsets
        return joined_by.join([buffer[at[i] : at[i + 1]] for i in ids])


class _Pairs(dict):
    """Memo of the pair-compatibility table, keyed by left << 20 | right."""

    def __init__(self, compatible, size: int = 500_000):
        super().__init__()
        self._compatible, self._size = compatible, size

    def __missing__(self, key: int) -> bool:
        if len(self) >= self._size:
            self.clear()
        self[key] = value = self._compatible(key >> 20, key & 0xFFFFF)
        return value


class BacktrackingBPE:
    """Exact BPE of one word given as a string over base symbols.

    A word's symbols are single characters; ``suffix`` (if any) marks the last
    one, written internally as one private-use character, so that a token is a
    plain string and a prefix of a token is a prefix of its string.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        base = {chr(0xE000 + i): c for i, c in enumerate(byte_alphabet())}
        self._last = {c: p for p, c in base.items()}

        def inner(token: str) -> str:
            if suffix and token.endswith(suffix) and len(token) > len(suffix):
                head = token[: -len(suffix)]
                return head[:-1] + self._last[head[-1]]
            return token

        # Rank order: base symbols first, then merges as they are listed.
        made: dict[str, tuple[str, str]] = {}
        for a, b in merges:
            made.setdefault(inner(a) + inner(b), (inner(a), inner(b)))
        names = {inner(t): i for t, i in vocab.items()}
        singles = [s for s in names if s not in made]
        self._strings = singles + [s for s in made if s in names]
        rank = {s: r for r, s in enumerate(self._strings)}
        self._ids = [names[s] for s in self._strings]
        self._halves = [(r, r) for r in range(len(singles))]
        self._halves += [(rank[made[s][0]], rank[made[s][1]]) for s in self._strings[len(singles) :]]
        self._pair = {h: r for r, h in enumerate(self._halves) if r >= len(singles)}
        # A token that its own merges never reach can't appear in a result.
        reachable = [r < len(singles) or self._compatible(*self._halves[r], below=r) for r in range(len(self._strings))]
        self._lengths = [len(s) for s in self._strings]
        usable = {s: r for s, r in rank.items() if reachable[r]}
        self._shorter = [
            next((usable[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in usable), -1) for s in self._strings
        ]
        self._automaton = ahocorasick.Automaton()
        for s, r in usable.items():
            self._automaton.add_word(s, r)
        self._automaton.make_automaton()
        self._longest = max(map(len, usable), default=1)
        self._compatible_memo = _Pairs(self._compatible)

    def _compatible(self, left: int, right: int, below: int = 1 << 60) -> bool:
        """Does merging text(left) + text(right) by priority keep the border?
        Looks at the pairs that meet at the border, undoing the later merge of
        the two sides each time; a listed pair older than what was undone would
        have merged first. ``below``: only pairs of a smaller rank count."""
        pair, halves = self._pair, self._halves
        limit = below
        while True:
            if pair.get((left, right), limit) < limit:
                return False
            if left > right:
                limit = left
                if halves[left][1] == left:
                    return True
                left = halves[left][1]
            else:
                limit = right + 1
                if halves[right][0] == right:
                    # The right side can't be undone further; go on with the left.
                    limit = left
                    if halves[left][1] == left:
                        return True
                    left = halves[left][1]
                    continue
                right = halves[right][0]

    def encode(self, word: str) -> list[int]:
        """Ids of one non-empty word of stand-in characters."""
        if self.suffix:
            word = word[:-1] + self._last[word[-1]]
        # Mostly the longest matches in a row are compatible as they are.
        ids, compatible = self._ids, self._compatible_memo
        greedy = [r for _, r in self._automaton.iter_long(word)]
        last = -1
        for token in greedy:
            if last >= 0 and not compatible[last << 20 | token]:
                return self._backtrack(word)
            last = token
        return [ids[r] for r in greedy]

    def _backtrack(self, word: str) -> list[int]:
        n, lengths, compatible = len(word), self._lengths, self._compatible_memo
        out: list[int] = []
        closed: set[int] = set()  # positions found to be dead ends
        at = 0
        # The longest token at each position; the scan goes on by itself as
        # long as each longest token is the one taken. A scan covers a window,
        # so that a new one costs the same in a word of any length; a match
        # that the window's end might cut short is not taken from it.
        window = 4 * self._longest
        sure = window - self._longest
        matches = self._automaton.iter_long(word[:window])
        token = next(matches)[1]
        while True:
            last = out[-1] if out else -1
            longest = token
            while True:
                end = at + lengths[token]
                if end not in closed and (last < 0 or compatible[last << 20 | token]):
                    out.append(token)
                    at = end
                    if at == n:
                        return [self._ids[r] for r in out]
                    if token != longest or at > sure:
                        matches = self._automaton.iter_long(word[at : at + window])
                        sure = at + window - self._longest
                    token = next(matches)[1]
                    break
                shorter = self._shorter[token]
                if shorter >= 0:
                    token = shorter
                    continue
                closed.add(at)
                out.pop()
                at -= lengths[last]
                # Its end is closed now, so a shorter token is tried there and
                # the scan starts anew behind that.
                token = last
                break


# Fixed by the vocabulary files: how text is split before the merges.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
BYTE_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# Characters that str.split() takes as white space and Unicode does not.
_SEPARATORS = regex.compile("[\x1c-\x1f]")


class Tokenizer:
    """A ``tokenizers`` BPE file: encode whole texts, decode ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE":
            raise ValueError("only BPE files can be read")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.bpe = BacktrackingBPE(model["vocab"], merges, self.suffix)
        self.lower = spec.get("normalizer") is not None
        self.split = regex.compile(WORD_PATTERN if self.lower else BYTE_PATTERN)
        self._stand_in = {b: c for b, c in enumerate(byte_alphabet())}
        names = {**model["vocab"], **{a["content"]: a["id"] for a in spec["added_tokens"]}}
        texts = [""] * (max(names.values()) + 1)
        for name, i in names.items():
            texts[i] = name
        self.byte_level = spec.get("decoder") is not None
        back = {c: b for b, c in enumerate(byte_alphabet())}
        special = {a["id"] for a in spec["added_tokens"]}
        self.table = OffsetTable(
            [
                bytes(back[c] for c in t) if self.byte_level and i not in special else t.encode()
                for i, t in enumerate(texts)
            ]
        )
        self.memo = BoundedCache(self.word_ids, 100_000)
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._added = regex.compile("|".join(regex.escape(a) for a in sorted(self.added, key=len, reverse=True)))

    def word_ids(self, word: str) -> list[int]:
        if not (word.isascii() and word.isalnum()):  # those stand for themselves
            word = word.encode().decode("latin-1").translate(self._stand_in)
        return self.bpe.encode(word)

    def normalized(self, text: str) -> str:
        if not self.lower:
            return text
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # Character by character: no word-final form of sigma.
        return text.replace("Σ", "σ").lower()

    def segments(self, text: str) -> Iterator[tuple[str, int]]:
        """The stretches between added tokens as (text, -1), the added tokens
        as (text, id)."""
        if not self.added or "<" not in text:
            yield text, -1
            return
        at = 0
        for m in self._added.finditer(text):
            if m.start() > at:
                yield text[at : m.start()], -1
            yield m[0], self.added[m[0]]
            at = m.end()
        if at < len(text):
            yield text[at:], -1

    def words(self, text: str) -> list[str]:
        """The words of a stretch without added tokens."""
        return self.split.findall(self.normalized(text))

    def units(self, text: str) -> list[str]:
        """Coarser units of a word-level file whose ids, joined, are the ids of
        ``text``: a match of the word pattern never spans white space."""
        text = self.normalized(text)
        return self.split.findall(text) if _SEPARATORS.search(text) else text.split()

    def unit_ids(self, unit: str) -> list[int]:
        if unit.isalpha():  # exactly the letters of the pattern
            return self.memo[unit]
        head, last = unit[:-1], unit[-1]
        if self.lower and head.isalpha() and last in ",.;:!?)":
            return self.memo[head] + self.memo[last]
        return [i for w in self.split.findall(unit) for i in self.memo[w]]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part, added in self.segments(text):
            if added >= 0:
                out.append(added)
            else:
                for w in self.words(part):
                    out += self.word_ids(w)
        return out

    def decode(self, ids) -> str:
        if self.byte_level:
            return self.table.decode(ids).decode("utf-8", "replace")
        return self.table.decode(ids, b" ").decode()


@functools.lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    """One tokenizer per file and Python worker."""
    return Tokenizer(path)


@functools.lru_cache(maxsize=4)
def _unit_memo(path: str) -> BoundedCache:
    tok = load(path)

    def compute(unit: str) -> tuple[int, str, bytes]:
        ids = tok.unit_ids(unit)
        return len(ids), " ".join(map(str, ids)), tok.table.decode(ids, b" ")

    return BoundedCache(compute)


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, ``n_tokens``, ``ids`` (decimal ids joined by one
    space) and ``decoded`` (the ids decoded again), for a word-level file
    (one with a normalizer, whose tokens are decoded joined by spaces).

    Each row stands alone: no shuffle, repeated rows give repeated results. A
    null text counts as empty; an empty text gives 0 tokens and empty strings;
    a null id stays null. Other columns are not read.
    """
    schema = pa.schema(
        [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())]
    )

    def rows(batches):
        tok, memo = load(tokenizer), _unit_memo(tokenizer)
        get = memo.__getitem__
        for batch in pieces(batches):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found: list[tuple[int, str, bytes]] = []
                for part, added in tok.segments(text):
                    if added >= 0:
                        found.append((1, str(added), part.encode()))
                    else:
                        found += map(get, tok.units(part))
                found = [f for f in found if f[0]]
                yield {
                    "id": key,
                    "n_tokens": sum([f[0] for f in found]),
                    "ids": " ".join([f[1] for f in found]),
                    "decoded": b" ".join([f[2] for f in found]).decode(),
                }

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    out = narrow.mapInArrow(arrow_rows(rows, schema), "id long, n_tokens long, ids string, decoded string")
    return out.withColumnRenamed("id", id_col)

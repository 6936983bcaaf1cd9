"""Quality rules by compression bands.

A text is compressed with zstandard as a whole and in chunks of a fixed size.
Repetitive text compresses far better than prose, lists and symbol strings
somewhat better, noise worse, and how far prose compresses depends on its length;
so every band of lengths (two to a doubling) has its own lower and upper limit for
the ratio (bytes before / bytes after). A text is rejected when its whole ratio
leaves the limits of its band, or when at least ``chunk_share`` of its chunks do:
full chunks leave the chunk limits, what stands behind the last one (from
``least_tail`` bytes) the limits of its length.

The default limits were measured on texts labelled good that pass the base rule:
the range of their ratios in a band, widened by 0.01 to 0.1. They belong to prose
in Latin letters at zstandard level 3; other text needs limits of its own.

Beside that verdict stand the base counts over words (runs without ASCII white
space) and the base rule over them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from acctflow.llm.common import with_columns_of_text

SYMBOLS = re.compile("[#*$%&|<>]")


@dataclass(frozen=True)
class Bands:
    """(bytes up to, lowest ratio, highest ratio); the last band is open."""

    whole: tuple[tuple[float, float, float], ...] = (
        (256, 0.0, 2.0),
        (362, 1.3, 1.75),
        (512, 1.34, 1.88),
        (724, 1.4, 1.92),
        (1024, 1.52, 2.03),
        (1448, 1.64, 2.1),
        (2048, 1.75, 2.15),
        (2896, 1.8, 2.21),
        (4096, 1.9, 2.28),
        (5793, 1.94, 2.34),
        (8192, 2.05, 2.38),
        (11585, 2.13, 2.42),
        (16384, 2.18, 2.46),
        (23170, 2.23, 2.5),
        (32768, 2.24, 2.54),
        (65536, 2.28, 2.6),
        (float("inf"), 2.3, 2.75),
    )
    chunk_bytes: int = 4096
    chunk_low: float = 1.93
    chunk_high: float = 2.3
    chunk_share: float = 0.5
    least_tail: int = 512
    level: int = 3


def word_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    raw = text.encode()
    words = raw.split()  # bytes: exactly the six ASCII white-space characters
    n = len(words)
    space = raw.count(b" ") + sum(map(raw.count, (b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():  # a line with a word
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeat = 0
    if len(set(windows)) < len(windows):
        first: dict = {}
        covered = bytearray(n)
        for i, w in enumerate(windows):
            at = first.setdefault(w, i)
            if at != i:
                covered[at : at + 3] = covered[i : i + 3] = b"\x01\x01\x01"
        repeat = covered.count(1)
    return n, len(text) - space, len(SYMBOLS.findall(text)), dup, repeat


def band_verdict(raw: bytes, bands: Bands, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, bool]:
    """(whole ratio, chunks judged, chunks outside their limits, rejected)."""
    if not raw:
        return 0.0, 0, 0, False

    def inside(ratio: float, n: int) -> bool:
        low, high = next((lo, hi) for top, lo, hi in bands.whole if n <= top)
        return low <= ratio <= high

    def ratio_of(part: bytes | memoryview) -> float:
        return len(part) / len(compressor.compress(part))

    ratio, size, held = ratio_of(raw), bands.chunk_bytes, memoryview(raw)
    full = len(raw) // size
    bad = sum(not bands.chunk_low <= ratio_of(held[at : at + size]) <= bands.chunk_high for at in range(0, full * size, size))
    tail = len(raw) - full * size
    judged = full
    if full and tail >= bands.least_tail:
        judged += 1
        bad += not inside(ratio_of(held[full * size :]), tail)
    return ratio, judged, bad, not inside(ratio, len(raw)) or judged > 0 and bad >= bands.chunk_share * judged


def quality(
    docs: DataFrame, bands: Bands = Bands(), min_words: int = 50, max_repeat_pct: int = 50,
    id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: the id, the base counts, ``ratio``, ``n_chunks``,
    ``n_bad_chunks``, ``base_failed`` and ``kept``; with ``keep``, those columns
    of ``docs`` beside them.

    No shuffle: every row stands alone, repeated rows give repeated results. A
    null or empty text has no words, so it fails the base rule. A null id stays
    null; columns not named in ``keep`` are not read.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chunks", "n_bad_chunks")
    kinds = [pa.int64()] * len(counts) + [pa.float64(), pa.bool_(), pa.bool_()]
    schema = ", ".join(f"{c} long" for c in counts) + ", ratio double, base_failed boolean, kept boolean"

    def make():
        compressor = zstandard.ZstdCompressor(level=bands.level)

        def judge(text: str) -> tuple:
            n, chars, symbols, dup, repeat = word_counts(text)
            ratio, chunks, bad, rejected = band_verdict(text.encode(), bands, compressor)
            failed = n < min_words or 100 * repeat > max_repeat_pct * n
            return n, chars, symbols, dup, repeat, chunks, bad, ratio, failed, not (failed or rejected)

        def arrays(texts: list[str]) -> list[pa.Array]:
            found = list(map(judge, texts))
            return [pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)]

        return arrays

    return with_columns_of_text(docs, text_col, keep or (id_col,), schema, make)

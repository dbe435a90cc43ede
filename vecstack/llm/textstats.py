"""Per-document statistics of whole texts, vectorised over blocks (see ``words``)."""

from __future__ import annotations

import numpy as np

from vecstack.llm.words import SPACE, Block, mix

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def _per_text(block: Block, flag):
    """Number of set bytes of each text."""
    c = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=c[1:])
    return c[block.offset[1:]] - c[block.offset[:-1]]


def _by_text(block: Block, doc, values):
    """Values that tell equal values of different texts apart."""
    return mix(values ^ mix(doc.astype(np.uint64) + np.uint64(1)))


def base_stats(b: Block) -> dict:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text (``lower=False``)."""
    word_byte = ~SPACE[b.raw]
    out = {"n_words": b.counts.astype(np.int64),
           "word_chars": _per_text(b, word_byte & ((b.raw & 0xC0) != 0x80)),
           "n_symbols": _per_text(b, SYMBOLS[b.raw])}
    start, end, doc = b.lines()
    c = np.zeros(len(word_byte) + 1, np.int64)
    np.cumsum(word_byte, out=c[1:])
    held = c[end] > c[start]
    start, end, doc = start[held], end[held], doc[held]
    _, first = np.unique(_by_text(b, doc, b.value(start, end)), return_index=True)
    out["n_lines"] = np.bincount(doc, minlength=b.n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(doc[first], minlength=b.n)
    h, inside = b.grams(3)
    at = np.flatnonzero(inside)
    _, which, n = np.unique(_by_text(b, b.doc[at], h[at]), return_inverse=True, return_counts=True)
    again = at[n[which] > 1]
    cover = np.zeros(len(b.word) + 3, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + 3, -1)
    covered = np.cumsum(cover)[:len(b.word)] > 0
    out["n_repeat_words"] = np.bincount(b.doc[covered], minlength=b.n)
    return out


def quality_features(b: Block) -> tuple[list[str], np.ndarray]:
    """Names and a float matrix of document statistics (0 where a text has nothing to measure)."""
    s = base_stats(b)
    raw, n = b.raw, np.maximum(s["n_words"], 1)
    size = np.maximum(b.sizes, 1)
    share = lambda flag: _per_text(b, flag) / size
    upper, lower, digit = (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122), (raw >= 48) & (raw <= 57)
    ascii_punct = (raw > 32) & (raw < 127) & ~(upper | lower | digit)
    length = (b.end - b.start).astype(float)
    mean = lambda v: np.bincount(b.doc, v, minlength=b.n) / n
    avg = mean(length)
    key = _by_text(b, b.doc, b.word)
    _, first, count = np.unique(key, return_index=True, return_counts=True)
    d, p = b.doc[first], count / n[b.doc[first]]
    top = np.zeros(b.n)
    np.maximum.at(top, d, p)
    again = np.zeros(len(key), bool)
    again[1:] = key[1:] == key[:-1]
    lines = np.maximum(s["n_lines"], 1)
    last = raw[np.maximum(b.end - 1, 0)] if len(b.end) else np.zeros(0, np.uint8)
    f = {
        "words": np.log1p(s["n_words"]), "bytes": np.log1p(b.sizes), "lines": np.log1p(s["n_lines"]),
        "words_per_line": s["n_words"] / lines, "word_length": avg,
        "word_length_sd": np.sqrt(np.maximum(mean(length ** 2) - avg ** 2, 0)),
        "long_words": mean(length > 14), "short_words": mean(length <= 3), "one_char_words": mean(length == 1),
        "upper": share(upper), "lower": share(lower), "digit": share(digit), "punctuation": share(ascii_punct),
        "high_bytes": share(raw >= 128), "control": share((raw < 32) & ~SPACE[raw]),
        "symbols": s["n_symbols"] / n, "exclaim": share(raw == 33), "bars": share(raw == 124),
        "stops": share(raw == 46), "commas": share(raw == 44), "question": share(raw == 63), "colon": share(raw == 58),
        "slash": share(raw == 47), "at": share(raw == 64), "angle": share((raw == 60) | (raw == 62)),
        "title_words": mean(upper[b.start]) if len(b.start) else np.zeros(b.n),
        "stop_words": mean(last == 46) if len(last) else np.zeros(b.n),
        "distinct": np.bincount(d, minlength=b.n) / n, "top_word": top,
        "simpson": np.bincount(d, p * p, minlength=b.n),
        "entropy": np.bincount(d, -p * np.log(np.maximum(p, 1e-12)), minlength=b.n) / np.log(n + 1.0),
        "same_as_last": mean(again), "dup_lines": s["n_dup_lines"] / lines, "repeat_words": s["n_repeat_words"] / n,
        "spaces": share(raw == 32),
    }
    return list(f), np.column_stack([np.asarray(v, float) for v in f.values()])

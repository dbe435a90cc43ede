"""Operator 5: byte-level BPE encoding and decoding.

Every pre-token (match of the split pattern) is seen as Latin-1 text, one character per byte, so
that pyahocorasick reports all vocabulary matches in one pass.  Encoding walks from longest match
to longest match and backtracks: a token may follow another only if the merges keep the two apart
(``_Vocabulary.compatible``, memoised), and positions proven to be dead ends are not tried again.
That reproduces the merges exactly, in time linear in the length of the pre-token, also for very
long ones.  Ids decode by concatenating the byte strings of the tokens.

Defined results: a null text is the empty text; an empty text has no ids and decodes to no bytes;
a null ``doc_id`` is carried through; every row gives one row.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecstack.llm.common import texts

PIECES = 1 << 18     # pre-tokens kept with their ids, per Python worker (about 60 MB)
PAIRS = 1 << 16      # adjacent-token decisions kept, per Python worker
NEVER = 1 << 62


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ids."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(r): base64.b64decode(t) for t, r in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0..n-1")
    return [ranks[i] for i in range(len(ranks))]


class _Pieces(dict):
    """Ids of pre-tokens; unknown ones are encoded on the way."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str):
        ids = tuple(self.encode(piece.encode("utf-8")))
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Vocabulary:
    """Encoder and decoder over a list of tokens in merge order."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import ahocorasick
        import regex
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.matches = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, t in enumerate(tokens):
            self.matches.add_word(t.decode("latin-1"), i)
        self.matches.make_automaton()
        self.compatible = lru_cache(PAIRS)(self._compatible)
        self.shorter = lru_cache(PAIRS)(self._shorter)
        self.halves = lru_cache(PAIRS)(self._halves)
        self.edge = lru_cache(PAIRS)(self._edge)
        self.pieces = _Pieces(self.encode_piece)
        self.trips = _Trips(self)

    def merged(self, data: bytes, below: int = NEVER) -> list[int]:
        """The definition: merge the adjacent pair of lowest rank until none (``below``) is left."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get(x + y, NEVER) for x, y in zip(parts, parts[1:])]
            low = min(ranks)
            if low >= below:
                break
            i = ranks.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.rank[p] for p in parts]

    def _halves(self, token: int) -> list[int]:
        """The two tokens whose merge makes ``token`` (itself if it is a single byte)."""
        return self.merged(self.tokens[token], token)

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at one edge of ``token`` while it is merged together, earliest first: each
        with the rank of the merge that takes it up (``NEVER`` for the whole token)."""
        out, until = [], NEVER
        while True:
            out.append((self.tokens[token], until))
            if len(self.tokens[token]) == 1:
                return out[::-1]
            until, token = token, self.halves(token)[side]

    def _compatible(self, a: int, b: int) -> bool:
        """Whether no merge across the border of ``a`` and ``b`` comes before those inside them.

        Merges of equal rank are done from the left: inside ``a``, across, inside ``b``."""
        left, right = self.edge(a, -1), self.edge(b, 0)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            across = self.rank.get(x + y, NEVER)
            if across < x_until and across <= y_until and across != NEVER:
                return False
            if x_until == y_until == NEVER:
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``, or -1."""
        t = self.tokens[token]
        for n in range(len(t) - 1, 0, -1):
            if t[:n] in self.rank:
                return self.rank[t[:n]]
        return -1

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        n, tokens = len(piece), self.tokens
        longest = [-1] * n
        for end, token in self.matches.iter(piece.decode("latin-1")):
            longest[end + 1 - len(tokens[token])] = token      # later ends are longer
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            end = at + len(tokens[token])
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
                continue
            token = self.shorter(token)
            if token < 0:                  # nothing fits here: give back the last token, try its prefixes
                dead[at] = 1
                token = out.pop()
                at -= len(tokens[token])
        return out

    def encode(self, text: str) -> list[int]:
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_LOADED: dict = {}


def vocabulary(shared, pattern: str) -> Vocabulary:
    """The worker's vocabulary of a broadcast token list, built once."""
    key = (shared.value[0], len(shared.value[1]), pattern)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(shared.value[1], pattern)
    return _LOADED[key]


def share(docs: DataFrame, path: str):
    """Broadcast the tokens of a rank file (the size of one vocabulary, a few MB)."""
    return docs.sparkSession.sparkContext.broadcast((path, load_ranks(path)))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids ARRAY<INT>)`` of every row of ``docs(doc_id, text)``."""
    shared = share(docs, path)

    def run(parts):
        import numpy as np
        import pandas as pd
        v = vocabulary(shared, pattern)
        for pdf in parts:
            for i in range(0, len(pdf), 1000):
                part = pdf.iloc[i:i + 1000]
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": [np.array(v.encode(t), np.int32) for t in part["text"]]})

    return texts(docs).mapInPandas(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with the column ``decoded BINARY``: the bytes of ``ids`` (null: no bytes)."""
    shared = share(encoded, path)

    def run(parts):
        import pandas as pd
        tokens = shared.value[1]
        for pdf in parts:
            for i in range(0, len(pdf), 1000):
                part = pdf.iloc[i:i + 1000]
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": part["ids"],
                                    "decoded": [b"" if x is None else b"".join(map(tokens.__getitem__, x.tolist())) for x in part["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(run, "doc_id bigint, ids array<int>, decoded binary")


class _Trips(dict):
    """Decimal ids and decoded bytes of pre-tokens, each encoded and decoded once."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def renew(self):
        """Start anew, but keep what comes up again."""
        self.older = dict(self)
        self.clear()

    def __missing__(self, piece: str):
        if piece in self.older:
            self[piece] = trip = self.older.pop(piece)
            return trip
        v = self.vocabulary
        ids = v.encode_piece(piece.encode("utf-8"))
        trip = " ".join(map(str, ids)).encode(), v.decode(ids)
        if len(piece) <= 64:
            self[piece] = trip
        return trip


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row: ids encoded, then decoded.

    Pre-tokens are encoded apart from each other, so each one's ids and their bytes are found once, and a text's
    are put together from them; the digests are taken where the ids are."""
    shared = share(docs, path)

    def run(parts):
        import hashlib

        import pandas as pd
        v = vocabulary(shared, pattern)
        trips = v.trips
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for pdf in parts:
            n, coded, decoded = [], [], []
            for t in pdf["text"]:
                if len(trips) > PIECES // 2:
                    trips.renew()
                found = list(map(trips.__getitem__, v.split(t)))
                ids = b" ".join([x for x, _ in found])
                n.append(ids.count(b" ") + 1 if ids else 0)
                coded.append(sha(ids))
                decoded.append(sha(b"".join([x for _, x in found])))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": n, "ids_sha256": coded, "decoded_sha256": decoded})

    return texts(docs).mapInPandas(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")

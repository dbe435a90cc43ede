"""Operator 10: secret scan with dictionary-primed compression novelty.

Base kinds are found by three patterns.  Beyond them, every string of 8 or more characters in a
sensitive context (a whole line that speaks of keys, credentials, passwords ..., the ``FOLLOWING``
lines after it, and the body of a PEM block to its end) is a candidate if it mixes letters and digits.
A compressor cannot tell a short random string from a rare word with a number, so those under
``LONG`` characters also need ``CHANGES`` changes between lower case, upper case and digits; the lines
of a PEM body need neither.  A candidate's marginal compressed
size is measured with zstandard, primed with a dictionary of identifiers and with the text around
the candidate.  Strings that the primed compressor cannot shorten are novel, hence secrets
(kind ``novel``).

Defined results: a null text is the empty text; an empty text has no spans; a null ``doc_id`` is
carried through; every row gives one row.  Spans are code points, end exclusive.  Extra columns are
ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecstack.llm.common import texts

KINDS = ("assign", "access", "hex", "novel")
MIN_BITS = 4.0          # marginal compressed bits per character of a novel string
CONTEXT = 200           # characters on either side that prime the compressor
FOLLOWING = 3           # lines after a sensitive one that belong to its context
LONG, CHANGES = 20, 3   # shorter candidates need so many changes of character class
MASK = "[SECRET]"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Words that make a line sensitive.
SENSITIVE = ("password", "passwd", "secret", "token", "apikey", "api_key", "api-key", "credential", "private key",
             "private_key", "privatekey", "access_key", "accesskey", "access key", "authorization", "bearer",
             "client_secret", "signing_key", "encryption_key", "connection_string")
SENSITIVE_RE = re.compile("|".join(map(re.escape, SENSITIVE)), re.ASCII | re.IGNORECASE)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
RUNS = re.compile(r"[0-9]+|[a-z]+|[A-Z][a-z]+|[A-Z]+")      # a capitalised word is one run
PEM = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----")
PEM_LINE = re.compile(r"^[ \t>#*]*([A-Za-z0-9+/=]+)[ \t]*\r?$", re.MULTILINE)

#: Identifiers and phrases common in code, the start of every compressor dictionary.
IDENTIFIERS = (
    "public static void final class return import from export const function default string integer boolean "
    "value values config configuration settings environment variable request response header headers content type "
    "application json username password passwd secret token api_key apikey access_key secret_key client_id "
    "client_secret private_key public_key authorization bearer credential credentials connection_string database "
    "hostname localhost example.com https://www. http:// .internal .local user admin root test example placeholder "
    "changeme your_password_here your_api_key_here your-token-here xxxxxxxx 00000000 12345678 abcdefgh ABCDEFGH "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 null none true false undefined process.env "
    "os.environ getenv base64 sha256 md5 uuid session cookie account service endpoint region bucket version")


def mixed(word: str) -> bool:
    """Whether a string has letters and digits and, if short, changes its character class often."""
    if not (any(x.isdigit() for x in word) and any(x.isalpha() for x in word)):
        return False
    return len(word) >= LONG or len(RUNS.findall(re.sub("[^A-Za-z0-9]", "", word))) > CHANGES


def contexts(text: str) -> list[tuple[int, int]]:
    """Disjoint ranges of whole lines: each sensitive line and the ``FOLLOWING`` lines after it."""
    out, at = [], 0
    while (m := SENSITIVE_RE.search(text, at)) is not None:
        lo = text.rfind("\n", 0, m.start()) + 1
        at = hi = _line_end(text, m.end())
        for _ in range(FOLLOWING):
            hi = _line_end(text, hi + 1)
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def _line_end(text: str, at: int) -> int:
    end = text.find("\n", at)
    return len(text) if end < 0 else end


def pem_bodies(text: str) -> list[tuple[int, int]]:
    """Ranges of the lines after ``-----BEGIN ... PRIVATE KEY-----`` up to its end line (without one:
    as long as the lines are base64)."""
    out = []
    for m in PEM.finditer(text):
        lo = min(len(text), _line_end(text, m.end()) + 1)
        hi, begin = text.find("-----END", lo), text.find("-----BEGIN", lo)
        if hi < 0 or 0 <= begin < hi:
            hi = lo
            while hi < len(text) and PEM_LINE.fullmatch(text, hi, _line_end(text, hi)):
                hi = min(len(text), _line_end(text, hi) + 1)
        out.append((lo, hi))
    return out


class Scanner:
    """Finds the spans of one text; ``words`` extend the identifier dictionary."""

    def __init__(self, words=(), min_bits: float = MIN_BITS):
        self.prime = (IDENTIFIERS + " " + " ".join(words)).encode("utf-8", "replace")
        self.min_bits = min_bits

    def base(self, text: str) -> list[tuple[int, int, int]]:
        """``(start, kind, end)`` of the base kinds."""
        out = []
        low = text.lower()
        if any(w in low for w in ASSIGN_WORDS):
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(out)

    def novelty(self, text: str, start: int, end: int) -> float:
        """Marginal compressed bits per character of ``text[start:end]`` in its surroundings."""
        import zstandard
        before, after = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
        around = (before + after).encode("utf-8", "replace")
        prime = zstandard.ZstdCompressionDict(self.prime + around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(19, write_content_size=False, write_checksum=False)
        size = lambda b: len(zstandard.ZstdCompressor(dict_data=prime, compression_params=params).compress(b))
        piece = text[start:end].encode("utf-8", "replace")
        return 8.0 * max(0, size(around + piece) - size(around)) / (end - start)

    def novel(self, text: str, taken) -> list[tuple[int, int, int]]:
        """Candidates of sensitive contexts, outside the spans ``taken``, that do not compress."""
        bodies = pem_bodies(text)
        found = {m.span(1) for lo, hi in bodies for m in PEM_LINE.finditer(text, lo, hi)}
        for lo, hi in contexts(text):
            found |= {c.span() for c in CANDIDATE.finditer(text, lo, hi)
                      if mixed(c.group()) and all(c.end() <= a or b <= c.start() for a, b in bodies)}
        return [(s, 3, e) for s, e in sorted(found)
                if all(e <= a or b <= s for a, _, b in taken) and self.novelty(text, s, e) >= self.min_bits]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        base = self.base(text)
        return sorted(base + self.novel(text, base)) if SENSITIVE_RE.search(text) else base


def redact(text: str, spans) -> str:
    """``text`` with every maximal run of spans replaced by ``MASK``."""
    out, at = [], 0
    for s, _, e in sorted(spans):
        if s >= at:
            out.append(text[at:s])
            out.append(MASK)
        at = max(at, e)
    return "".join(out) + text[at:]


def context_words(docs: DataFrame, limit: int = 2000) -> list[str]:
    """The identifiers found in most sensitive lines of the corpus (at most ``limit``, a dictionary
    of a few KB): what many documents say next to a key is not a secret of one."""
    def run(parts):
        import pandas as pd
        word = re.compile(r"[A-Za-z_]{4,24}")
        for pdf in parts:
            found: list[str] = []
            for t in pdf["text"]:
                if SENSITIVE_RE.search(t):
                    seen = set()
                    for line in t.split("\n"):
                        if SENSITIVE_RE.search(line):
                            seen.update(word.findall(line))
                    found += seen
            if found:
                yield pd.Series(found, name="word").value_counts().rename("n").rename_axis("word").reset_index()

    top = (texts(docs).select("text").mapInPandas(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
           .where("n >= 3").orderBy(F.desc("n"), "word").limit(limit).collect())
    return [r["word"] for r in reversed(top)]       # the most frequent ones last, nearest to the data


def scan(docs: DataFrame, words: list[str] | None = None, min_bits: float = MIN_BITS) -> DataFrame:
    """``(doc_id, spans ARRAY<STRUCT<kind, start, end>>)`` of every row of ``docs``."""
    words = context_words(docs) if words is None else words

    def run(parts):
        import pandas as pd
        scanner = Scanner(words, min_bits)
        for pdf in parts:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "spans": [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scanner.spans(t)] for t in pdf["text"]]})

    return texts(docs).mapInPandas(run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def report(docs: DataFrame, **options) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans as text."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda a: F.array_join(F.transform(a, one), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias("n_" + kind)
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return scan(docs, **options).select("doc_id", n("assign"), n("access"), n("hex"),
                                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                                        n("novel"))


def redacted(docs: DataFrame, words: list[str] | None = None, min_bits: float = MIN_BITS) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[SECRET]``; rows and other columns stay."""
    words = context_words(docs) if words is None else words

    @F.pandas_udf("string")
    def clean(text):
        scanner = Scanner(words, min_bits)
        return text.map(lambda t: None if t is None else redact(t, scanner.spans(t)))

    return docs.withColumn("text", clean(docs["text"].cast("string")))

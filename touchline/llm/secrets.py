"""Secrets in text: three fixed patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary spends few tokens on what is common in text and code, and many on random strings. A run of at
least LEAST_RUN characters that tokens, keys and identifiers are made of is reported (kind "random") if it holds a letter,
is no known digest or identifier, and has at most MOST_RATIO characters a token (SHORT_RATIO under LONG_RUN characters,
where words come closer to random strings). Letters alone are tested like any others. The vocabulary is loaded once on
the driver (about 1 MB) and broadcast.

Spans are in code points, ends exclusive; bytes that are no UTF-8 count as U+FFFD, as many as Python's "replace" puts. A
null text counts as empty. Every text is searched whole, of whatever length; rows are independent, so repeated rows get
repeated results and an empty table an empty one. Only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import base64
import hashlib
import re

from pyspark.sql import DataFrame

from .common import with_computed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's own pre-tokenising pattern (a fixed value).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: In the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww](?:[Oo][Rr])?[Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20

LEAST_RUN, LONG_RUN = 16, 20
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
#: Known digests: hexadecimal of the lengths of MD5, SHA-1 and SHA-2; and UUIDs.
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})\Z")
#: Identifiers: short groups of letters, each with at most a short number behind, or short numbers, joined by _ - or /.
IDENTIFIER = re.compile(r"(?:[A-Za-z]{1,10}[0-9]{0,4}|[0-9]{1,8})(?:[_/=+-]+(?:[A-Za-z]{1,10}[0-9]{0,4}|[0-9]{1,8}))+[_/=+-]*\Z")
MOST_RATIO, SHORT_RATIO = 2.0, 1.7

COLUMNS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encoding(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("secrets", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end): what the three patterns match, less matches that are too short."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def random_spans(text: str, encode, most: float = MOST_RATIO) -> list[tuple[int, int, int]]:
    found = []
    for m in RUN.finditer(text):
        run = m[0]
        if not re.search("[A-Za-z]", run) or DIGEST.match(run) or IDENTIFIER.match(run):
            continue
        if len(run) <= (most if len(run) >= LONG_RUN else most * SHORT_RATIO / MOST_RATIO) * len(encode(run)):
            found.append((m.start(), 3, m.end()))
    return found


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def find_secrets(docs: DataFrame, vocabulary: str = VOCABULARY, most: float = MOST_RATIO) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))

    def make():
        encode = encoding(ranks.value).encode_ordinary

        def scan(texts: list[bytes | None]) -> list[list]:
            out: list[list] = [[], [], [], [], []]
            for raw in texts:
                text = (raw or b"").decode("utf-8", "replace")
                base = base_spans(text)
                # A random string within a base span is that span's secret, not another one.
                more = [x for x in random_spans(text, encode, most) if not any(b[0] <= x[0] and x[2] <= b[2] for b in base)]
                row = (*(sum(x[1] == k for x in base) for k in range(3)), hashlib.sha256(written(base).encode()).hexdigest(), written(base + more))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            return out

        return scan

    return with_computed(docs.select("doc_id", "text"), ["text"], COLUMNS, make, ("text",))

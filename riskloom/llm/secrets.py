"""Secrets: fixed patterns, and a token-efficiency test for random strings.

Three base kinds are found by pattern (``BASE``). The method adds the kind ``random``: a run of characters that keys and
tokens are made of, with letters, for which a public byte-pair vocabulary needs many tokens: fewer than
``CHARS_PER_TOKEN`` characters each. Words and names compress well under such a vocabulary, random characters do not.
Left out are digests of known lengths, UUIDs, plain numbers and dates, runs that touch a base span, and addresses, paths and
names whose every part is like a word by the same ratio. Of a run that dots, dashes or slashes join from words and
keys, the stretches whose own tokens are short are reported, else the whole run if its ratio is low. Runs without a digit and in one case count from
``LEAST_LETTERS`` characters on, as rare words have low ratios too. Only the candidates are tokenised.

Places are code points, end exclusive. Defined results: null and empty texts have no spans; very long runs count as
one span like any other, or have a span per random stretch; repeated rows are reported each; extra columns are
ignored. An empty table gives an empty result. The vocabulary is read where the task runs, from ``vocabulary``.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: kind, pattern, group that is measured, least number of characters.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
)
KINDS = tuple(k for k, *_ in BASE) + ("random",)
# Every assign match has ":" or "=" after one of these endings, so a text without them needs no pattern.
_MAY_ASSIGN = re.compile(r"""(?:word|sswd|cret|oken|_?key)["']?\x20*[:=]""", re.I | re.A)

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHARS_PER_TOKEN = 2.0
LEAST_CHARS = 16
LEAST_LETTERS = 21
# Long runs are tokenised block by block: the time stays in proportion to their length.
BLOCK = 2_000
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=.-])(?=[0-9+/_=.-]*[A-Za-z])[A-Za-z0-9+/_=.-]{%d,}" % LEAST_CHARS)
EXCLUDED = re.compile(
    r"[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"  # digests
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"  # UUID
    r"|sha(?:1|256|384|512)-[A-Za-z0-9+/]+=*"  # integrity digests
    r"|[0-9.+=/_-]+"  # numbers, dates, versions
)
# Left out if every part is like a word.
NAMED = re.compile(
    r"[A-Za-z]*[0-9]{0,4}(?:[_.-][A-Za-z]*[0-9]{0,4})*"  # names of several words, with short numbers
    r"|/?(?:[A-Za-z0-9_.-]+/)+[A-Za-z_-]*[.]?[a-z]{0,4}"  # paths
)
#: Digests and UUIDs as parts of a longer run.
DIGEST = re.compile(
    r"(?<![0-9a-zA-Z])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|sha(?:1|256|384|512)-[A-Za-z0-9+/]+=*"
    r"|[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})(?![0-9a-zA-Z])"
)
_JOINED = re.compile(r"[A-Za-z0-9+]+")
_PART = re.compile(r"[A-Za-z0-9]+")
_NUMBER = re.compile(r"[0-9]{1,4}$")


def tokenizer(path: str = VOCABULARY) -> Callable[[str], int]:
    """Number of tokens of a string under a public vocabulary of byte pairs."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: sum(len(encoding.encode_ordinary(text[i : i + BLOCK])) for i in range(0, len(text), BLOCK))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, leftmost and non-overlapping per kind; short ones are dropped."""
    out = []
    for number, (kind, pattern, group, least) in enumerate(BASE):
        if kind == "assign" and not _MAY_ASSIGN.search(text):
            continue
        if kind == "access" and "AKIA" not in text:
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), number, m.end()))
    return sorted(out)


def is_name(run: str, tokens: Callable[[str], int], ratio: float = CHARS_PER_TOKEN) -> bool:
    """A path or name whose parts are numbers, of three letters at most, or like words; a short number may follow each."""
    if not NAMED.fullmatch(run):
        return False
    stems = (_NUMBER.sub("", part) for part in _PART.findall(run) if not part.isdigit())
    return all(len(stem) <= 3 or len(stem) >= ratio * tokens(stem) for stem in stems)


def _worth(part: str) -> bool:
    """Enough characters, with a letter; letters in one case only if there are many."""
    mixed = any(c.isdigit() for c in part) or not (part.islower() or part.isupper() or part.istitle())
    return len(part) >= (LEAST_CHARS if mixed else LEAST_LETTERS) and any(c.isalpha() for c in part) and not EXCLUDED.fullmatch(part)


def stretches(run: str, tokens: Callable[[str], int], ratio: float = CHARS_PER_TOKEN) -> list[tuple[int, int]]:
    """Places of random strings that are joined to words in one run.

    Parts between ``. _ = / -`` gain the characters that their tokens lack and lose those they have too many. A stretch
    goes on while its sum is above zero and ends where the sum was highest. Numbers, digests and parts of three
    characters at most count nothing.
    """
    out, sum_, most, first, last = [], 0.0, 0.0, -1, -1

    def close() -> None:
        if most > 0 and _worth(run[first:last]) and not is_name(run[first:last], tokens, ratio):
            out.append((first, last))

    digests = DIGEST.finditer(run)
    digest = next(digests, None)
    for m in _JOINED.finditer(run):
        part = m[0]
        while digest and digest.end() <= m.start():
            digest = next(digests, None)
        plain = len(part) <= 3 or part.isdigit() or bool(digest and digest.start() <= m.start())
        gain = 0.0 if plain else ratio * tokens(part) - len(part)
        if sum_ <= 0 < gain:
            first, sum_, most = m.start(), 0.0, 0.0
        sum_ += gain
        if sum_ > most and first >= 0:
            most, last = sum_, m.end()
        if sum_ <= 0 < most:
            close()
            first, sum_, most = -1, 0.0, 0.0
        sum_ = max(sum_, 0.0)
    close()
    return out


def random_spans(text: str, taken: list[tuple[int, int, int]], tokens: Callable[[str], int], ratio: float = CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """Runs with few characters per token that touch no base span."""
    out = []
    for m in CANDIDATE.finditer(text):
        run = m[0].strip(".=-/_+")
        start = m.start() + m[0].index(run)
        end = start + len(run)
        if len(run) < LEAST_CHARS or EXCLUDED.fullmatch(run) or any(s < end and start < e for s, _, e in taken):
            continue
        if len(run) < LEAST_LETTERS and not any(c.isdigit() for c in run) and (run.islower() or run.isupper() or run.istitle()):
            continue
        found = stretches(run, tokens, ratio)
        if not found and len(run) < ratio * tokens(run) and not DIGEST.search(run) and not is_name(run, tokens, ratio):
            found = [(0, len(run))]
        out.extend((start + a, len(KINDS) - 1, start + b) for a, b in found)
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCHEMA = "doc_id {key}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, ratio: float = CHARS_PER_TOKEN) -> DataFrame:
    """doc_id, counts per base kind, base_sha256, spans of all kinds and n_random for every row."""
    given = docs.select("doc_id", F.col("text").cast("string"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokenizer(vocabulary)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for value in batch["text"]:
                text = value.as_py() or ""
                base = base_spans(text)
                extra = random_spans(text, base, tokens, ratio)
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                row = [*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(sorted(base + extra)), len(extra)]
                for column, item in zip(columns, row):
                    column.append(item)
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *[pa.array(c, t) for c, t in zip(columns, kinds)]], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return given.mapInArrow(step, SCHEMA.format(key=given.schema["doc_id"].dataType.simpleString()))

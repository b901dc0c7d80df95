"""Secret scan with password guess-cost estimation (operator 3).

Three patterns find the base spans: assigned values, access keys and long hex
runs. Beyond them, values in a wider credential context (more key words, any
printable characters) become spans if guessing them would be costly: a dynamic
programme finds the cheapest way to build the value from dictionary words,
dates, repeats, keyboard walks and brute-force characters, and a value counts
as a secret from `MIN_BITS` bits of guessing work on. `changeme2024` is cheap,
`q7#Vz-0pLw` is not.
"""

from __future__ import annotations

import math
import re
from base64 import b64decode
from bisect import bisect_left
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlab.llm.text import row_slices

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX = re.compile(r"[0-9a-f]{16,}", re.ASCII)  # runs are maximal, so this drops the short ones
LEAST = {"assign": 12, "access": 18}
_KEY = (r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|client|auth)[_-]?key"""
        r"""|credentials?|bearer|auth(?:orization)?)""")
_ASSIGNED = _KEY + r"""["']?[\x20\t]*[:=]"""
#: The wider context: what a person or a config file writes before a credential. The value
#: follows, after a scheme word (`Authorization: Bearer`) if there is one; `bearer` needs no
#: sign before it. Where another key follows, the value is that key's.
CONTEXT = re.compile(
    "(?:" + _ASSIGNED + r"""[\x20\t]*+(?P<early>["']?+)(?:(?:bearer|basic|token|apikey)[\x20\t]++)?+"""
    r"""|(?P<bare>\bbearer)[\x20\t]++)(?!["']?""" + _ASSIGNED + r""")(?P<late>["']?+)""", re.IGNORECASE | re.ASCII)
#: What follows a bare `bearer` in prose: a word, no token.
PLAIN_WORD = re.compile(r"[A-Z]?[a-z]+(?:[-/'][A-Za-z]?[a-z]+)*[.!?:]*", re.ASCII)
#: What closes a quoted value, or ends its line.
CLOSING = re.compile(r"""(?<!\\)(?:\\\\)*(?:(["'])(?![A-Za-z0-9])|[\r\n])""")
#: A value without quotes ends before a blank, the next pair of a list, or a quote that ends something.
UNQUOTED = re.compile(r"""(?:(?![,;&][\x20\t]*["']?[A-Za-z_][\w.-]*["']?[\x20\t]*[:=]|["'](?:[\s,;:&)\]}>]|$))[!-~])*""",
                      re.ASCII)
MIN_BITS = 40.0           #: guessing work from which a value in context is a secret

#: Ranked vocabularies whose whole words extend the list below: a line per token, its base64 form and its rank.
VOCABULARIES = ("/opt/tokenizers/byte_bpe_50k.tiktoken", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Words that people build passwords of, the commonest first (own list, fixed values).
WORDS = """password admin login welcome letmein master dragon monkey shadow sunshine princess football baseball
superman batman qwerty iloveyou trustno michael jordan hunter ranger buster soccer hockey killer george charlie
andrew jessica pepper daniel access joshua maggie starwars silver william dallas yankees hello freedom computer
cheese amanda summer love ashley nicole chelsea biteme matthew access thunder taylor matrix minecraft pokemon
secret changeme default test testing guest user root demo example sample temp temporary public private server
service system database oracle mysql postgres redis spring winter autumn january february march april june july
august september october november december monday tuesday wednesday thursday friday saturday sunday london paris
berlin madrid america canada company office manager account network internet security backup please here your
none null true false empty unknown placeholder insert value string key token the and for you with this that""".split()
_LONGEST = 20             #: letters of the longest dictionary word
_LEET = str.maketrans("@4301$57!", "aaeoissti")
_KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
                   r"|(?:0?[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")
_SEGMENT_BITS = 1.0       #: what joining one more segment adds


@lru_cache(maxsize=2)
def dictionary(vocabularies: tuple[str, ...] = VOCABULARIES) -> dict[str, int]:
    """Word -> rank: `WORDS`, then the words of the vocabularies by their least rank.

    A word is a token that begins with a blank and is else letters only, four at
    least. Read by the driver, which sends it to the tasks: its size is that of
    the files (some 30,000 words), whatever the documents'.
    """
    ranks: dict[str, int] = {}
    for path in vocabularies:
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                word = b64decode(token).decode("utf-8", "replace")
                if word[0] == " " and word[1:].isalpha() and 4 <= len(word) - 1 <= _LONGEST:
                    word = word[1:].lower()
                    ranks[word] = min(int(rank), ranks.get(word, int(rank)))
    ordered = dict.fromkeys([*WORDS, *sorted(ranks, key=lambda w: (ranks[w], w))])
    return {w: i for i, w in enumerate(ordered, 1)}


def _near_keys() -> set[str]:
    """Pairs of keys beside each other on the rows, or next in the alphabet."""
    pairs = set()
    for r, row in enumerate(_KEY_ROWS):
        for i, key in enumerate(row):
            beside = [row[i + 1:i + 2]]
            if r + 1 < len(_KEY_ROWS):  # the row below stands half a key to the left
                below = _KEY_ROWS[r + 1]
                beside += [below[j] for j in (i - 1 - (r == 0), i - (r == 0)) if 0 <= j < len(below)]
            for other in filter(None, beside):
                pairs |= {key + other, other + key}
    for a, b in zip("abcdefghijklmnopqrstuvwxy", "bcdefghijklmnopqrstuvwxyz"):
        pairs |= {a + b, b + a}
    return pairs


_NEAR = _near_keys()


_SIZES = (10, 26, 26, 33)  #: digits, lower case, capitals, the rest of the printable characters
#: Bits a character by the set of classes it is drawn from, a bit per class.
_ALPHABET = [0.0] + [math.log2(sum(n for k, n in enumerate(_SIZES) if s >> k & 1)) for s in range(1, 16)]


def _class(c: str) -> int:
    return 1 if "0" <= c <= "9" else 2 if "a" <= c <= "z" else 4 if "A" <= c <= "Z" else 8


def _brute_bits(piece: str) -> float:
    """Cost of a piece by brute force over the classes that stand in it."""
    classes = 0
    for c in piece:
        classes |= _class(c)
    return len(piece) * _ALPHABET[classes]


def _word_bits(piece: str, ranks: dict[str, int]) -> float | None:
    """Cost of a piece as a dictionary word: its rank, capitals, substitutions, reversal."""
    lower = piece.lower()
    for extra, form in ((0, lower), (2, lower.translate(_LEET)), (1, lower[::-1])):
        if form in ranks:
            capitals = sum(c.isupper() for c in piece)
            how = 0 if not capitals else 1 if capitals in (1, len(piece)) and not piece[0].islower() else 3
            return math.log2(ranks[form]) + 1 + extra + how
    return None


def guess_bits(value: str, ranks: dict[str, int] | None = None, walk: int = 3) -> float:
    """log2 of the guesses of the cheapest segmentation of `value` (0 if empty), with the
    words of `ranks` (`dictionary()` if none is given).

    best[i] is the least cost of the first i characters; every segment that
    ends at i is a step. Words and dates are short and repeats and walks are
    followed while they last, so the work grows with the length. A brute-force
    segment costs the alphabet of all classes in it, or, where only its first
    letter is a capital, that of lower case and a bit; two of them are never side by side.
    """
    ranks = dictionary() if ranks is None else ranks
    n = len(value)
    best = [0.0] + [math.inf] * n
    brute = [math.inf] * 16   # by classes allowed: least cost of what ends in brute force
    titled = math.inf         # the same for a capital and lower-case letters
    clever = 0.0              # least cost of what ends in another segment, or of nothing
    lower = value.lower()
    dates: dict[int, list[int]] = {}
    for start in range(n):
        if value[start].isdigit() and (m := _DATE.match(value, start)):
            dates.setdefault(m.end(), []).append(start)
    walk_from = run_from = 0
    pairs: dict[int, int] = {}  # period -> where the repeat with that period began
    for end in range(1, n + 1):
        i = end - 1
        of, into = _class(value[i]), clever + _SEGMENT_BITS
        brute = [min(cost, into) + _ALPHABET[s] if s & of else math.inf for s, cost in enumerate(brute)]
        titled = (into + _ALPHABET[2] + 1 if of == 4 else titled + _ALPHABET[2] if of == 2 else math.inf)
        options = [math.inf]
        for start in range(max(0, end - _LONGEST), end - 2):
            if (bits := _word_bits(value[start:end], ranks)) is not None:
                options.append(best[start] + bits + _SEGMENT_BITS)
        for start in dates.get(end, ()):
            options.append(best[start] + math.log2(365 * 60 if end - start > 4 else 60) + _SEGMENT_BITS)
        if i and lower[i - 1] + lower[i] not in _NEAR:
            walk_from = i
        if end - walk_from >= walk:
            turns = math.log2(47) + math.log2(4) * math.sqrt(end - walk_from) + math.log2(end - walk_from)
            options.append(best[walk_from] + turns + _SEGMENT_BITS)
        for period in range(1, min(16, i) + 1):
            if value[i] == value[i - period]:
                run_from = pairs.setdefault(period, i - period)
                times = (end - run_from) / period
                if times >= 2 and end - run_from >= 3:
                    unit = _brute_bits(value[run_from:run_from + period])
                    options.append(best[run_from] + unit + math.log2(times) + _SEGMENT_BITS)
            else:
                pairs.pop(period, None)
        clever = min(options)
        best[end] = min(clever, titled, *brute)
    return best[n]


class Finding(NamedTuple):
    kind: str
    start: int          #: code points, whole match
    end: int
    value_start: int    #: where the secret itself begins
    bits: float         #: guess cost of the value


def _guesses(text: str, min_bits: float, ranks: dict[str, int] | None) -> list[Finding]:
    """Values in context that are costly to guess, each read to its own end, from where
    the search goes on."""
    found, closings, at = [], None, 0
    while m := CONTEXT.search(text, at):
        start, quote, end = m.end(), m["late"] or m["early"], -1
        if quote:
            if closings is None:  # all of them, once: a look-ahead per value could be quadratic
                closings = {q: [(c.end() - bool(c[1]), bool(c[1])) for c in CLOSING.finditer(text) if c[1] in (q, None)]
                            for q in ("'", '"')}
            k = bisect_left(closings[quote], (start,))
            if k < len(closings[quote]) and closings[quote][k][1]:
                end = closings[quote][k][0]
        if end < 0:
            run = UNQUOTED.match(text, start)
            end = start + len(run[0].rstrip("\"'`,;)]}>"))
        at = max(end, m.end())
        if m["bare"] and not quote and PLAIN_WORD.fullmatch(text, start, end):
            continue
        if end - start >= 8 and (bits := guess_bits(text[start:end], ranks)) >= min_bits:
            found.append(Finding("guess", m.start(), end, start, bits))
    return found


def find_secrets(text: str | None, min_bits: float = MIN_BITS,
                 ranks: dict[str, int] | None = None) -> list[Finding]:
    """All spans of one text, by start, then kind as in `KINDS`. A `guess` span
    is left out only where a base span's value holds all of its value; base spans stay
    whatever their cost."""
    if not text:
        return []
    found = [Finding("assign", m.start(), m.end(), m.start(2), guess_bits(m[2], ranks))
             for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [Finding("access", m.start(), m.end(), m.start(), guess_bits(m[0], ranks))
              for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [Finding("hex", m.start(), m.end(), m.start(), guess_bits(m[0], ranks)) for m in HEX.finditer(text)]
    if guesses := _guesses(text, min_bits, ranks):
        base = sorted((f.value_start, f.end) for f in found)
        reach = list(accumulate((end for _, end in base), max))
        for f in guesses:
            k = bisect_left(base, (f.value_start + 1,))
            if not k or reach[k - 1] < f.end:
                found.append(f)
    return sorted(found, key=lambda f: (f.start, KINDS.index(f.kind), f.end))


FINDINGS = ("array<struct<kind:string,span_start:bigint,span_end:bigint,value_start:bigint,guess_bits:double>>")
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("span_start", pa.int64()), ("span_end", pa.int64()),
                             ("value_start", pa.int64()), ("guess_bits", pa.float64())]))


def _shared_words(docs: DataFrame, ranks: dict[str, int] | None):
    return docs.sparkSession.sparkContext.broadcast(dictionary() if ranks is None else ranks)


def secret_spans(docs: DataFrame, min_bits: float = MIN_BITS, ranks: dict[str, int] | None = None) -> DataFrame:
    """(`doc_id`, `findings`) per row: every span of the whole text, in code points.

    Null and empty texts have an empty array, repeated rows repeat, an empty
    table gives no rows; other columns are not read. No shuffle.
    """
    words = _shared_words(docs, ranks)

    def run(batches):
        for b in row_slices(batches, "text"):
            found = [[dict(zip(("kind", "span_start", "span_end", "value_start", "guess_bits"), f))
                      for f in find_secrets(t, min_bits, words.value)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _ARROW)], names=["doc_id", "findings"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, findings {FINDINGS}")


def redact_text(text: str | None, mark: str = "[SECRET]", min_bits: float = MIN_BITS,
                ranks: dict[str, int] | None = None) -> str | None:
    """The text with every found value replaced by `mark`; touching values give one mark."""
    out, at = [], 0
    for start, end in sorted((f.value_start, f.end) for f in find_secrets(text, min_bits, ranks)):
        if start > at or not out:
            out += [text[at:start], mark]
        at = max(at, end)
    return text if not out else "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", min_bits: float = MIN_BITS,
                   ranks: dict[str, int] | None = None) -> DataFrame:
    """All rows and columns of `docs`, secrets in `text` replaced by `mark`, and
    `n_chars`, where it is the text's length, brought up to date. Rows without a finding
    pass unchanged."""
    words = _shared_words(docs, ranks)

    def run(batches):
        for b in row_slices(batches, "text"):
            old = b.column("text").to_pylist()
            new = [redact_text(t, mark, min_bits, words.value) for t in old]
            if old != new:
                at = b.schema.get_field_index("text")
                b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
                if (at := b.schema.get_field_index("n_chars")) >= 0:
                    chars = [len(y) if x != y and n == len(x) else n
                             for x, y, n in zip(old, new, b.column(at).to_pylist())]
                    b = b.set_column(at, b.schema.field(at), pa.array(chars, b.schema.field(at).type))
            yield b

    return docs.mapInArrow(run, docs.schema)

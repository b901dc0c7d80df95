"""Language identification by cross-parsing (operator 1).

For every language a suffix automaton is built of a bounded sample of its
labelled text. A text is cut greedily into the longest phrases that occur in
that sample; the fewer phrases, weighted by log2 of the sample's length (the
bits that name a phrase), the closer the language. The automata are laid out
as one dense transition table, so that a slice of many texts is parsed by all
languages at once, one table look-up per letter and lane.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlab.llm.text import row_slices

UNKNOWN = "und"
EXCERPTS = 96          #: sampled excerpts per language, at most
EXCERPT_CHARS = 320    #: characters per excerpt
BLOCK = 256            #: letters of a lane; a longer text takes several lanes, joined exactly
_STRIDE = 32           #: letters between the places where two parses of a lane are compared
_ROUNDS = 4            #: joint corrections of all lanes; what is left is corrected lane by lane


def learn_samples(labelled: DataFrame, excerpts: int = EXCERPTS,
                  excerpt_chars: int = EXCERPT_CHARS) -> dict[str, str]:
    """lang -> sample text from `labelled` (doc_id, text, lang).

    Rows are dealt to `excerpts` buckets per language by a hash of the text and the row
    with the least hash of each bucket gives one excerpt, from a place its hash
    names: a bounded sample that no row order or hot language changes. Rows
    without text or lang are left out. The result has `excerpts * excerpt_chars`
    characters per language at most; a language is one small string.
    """
    h = F.xxhash64("text")
    room = F.greatest(F.lit(1), F.length("text") - F.lit(excerpt_chars - 1))
    rows = (labelled.where("text is not null and lang is not null and length(text) > 0")
            .select("lang", h.alias("h"), F.pmod(h, F.lit(excerpts)).alias("bucket"),
                    F.substring("text", (F.pmod(F.shiftright(h, 20), room) + 1).cast("int"),
                                F.lit(excerpt_chars)).alias("excerpt")))
    best = rows.groupBy("lang", "bucket").agg(F.min(F.struct("h", "excerpt")).alias("x"))
    out: dict[str, str] = {}
    for r in best.select("lang", "x.excerpt").orderBy("lang", "bucket").collect():
        out[r["lang"]] = out.get(r["lang"], "") + " " + r["excerpt"]
    return {k: " ".join(v.split()) for k, v in out.items() if any(c.isalpha() for c in v)}


def suffix_automaton(symbols) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    moves, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return moves


class Parser:
    """Automata of all languages in one table.

    Symbol 0 is any run of non-letters, 1.. are the letters of the samples
    (lower-cased), then one symbol for every other letter and one for padding.
    A table entry holds the next state, and in its lowest two bits how many
    phrases end there.
    """

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        letters = sorted({c for s in samples.values() for c in s.lower() if c.isalpha()})
        self.letters = {c: i + 1 for i, c in enumerate(letters)}
        self.other, self.pad = len(letters) + 1, len(letters) + 2
        self.width = len(letters) + 3
        self.symbol = np.zeros(0x110000, np.uint16)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                self.symbol[cp] = self.letters.get(unicodedata.normalize("NFC", c.lower()), self.other)
        roots, bits, parts, base = [], [], [], 0
        codes = {lang: self._codes(samples[lang]) for lang in self.langs}
        # an automaton has fewer than two states per symbol
        kind = np.int32 if sum(2 * len(c) + 1 for c in codes.values()) * self.width < 1 << 28 else np.int64
        for lang in self.langs:
            moves = suffix_automaton(codes[lang].tolist())
            parts.append(self._table(moves, base, kind))
            roots.append(base * self.width)
            bits.append(np.log2(max(2, len(codes[lang]))))
            base += len(moves)
            del moves
        self.table = np.concatenate(parts) if parts else np.zeros(0, kind)
        self.roots, self.bits = np.array(roots, kind), np.array(bits)

    def _codes(self, text: str) -> np.ndarray:
        codes = self.symbol[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        return codes[(codes != 0) | np.append(True, codes[:-1] != 0)]

    def _table(self, moves, base: int, kind=np.int64) -> np.ndarray:
        w, root = self.width, base * self.width
        t = np.empty((len(moves), w), kind)
        # No move: the phrase ends and the next begins with this symbol, or,
        # where the root has no such move either, that symbol is a phrase too.
        t[:] = root << 2 | 2
        for c, to in moves[0].items():
            t[:, c] = (base + to) * w << 2 | 1
        t[0, [c for c in range(w) if c not in moves[0]]] = root << 2 | 1
        for s, out in enumerate(moves):
            for c, to in out.items():
                t[s, c] = (base + to) * w << 2
        t[:, self.pad] = (base + np.arange(len(moves))) * w << 2
        return t.ravel()

    def parse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrases per text and language, symbols, letters per text)."""
        n = len(texts)
        texts = [t or "" for t in texts]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        ends = np.cumsum([len(t) for t in texts])
        codes, row = self.symbol[points], np.repeat(np.arange(n), np.diff(ends, prepend=0))
        begins = np.zeros(len(codes), bool)
        begins[(ends - np.diff(ends, prepend=0))[np.diff(ends, prepend=0) > 0]] = True
        keep = (codes != 0) | begins | np.append(True, codes[:-1] != 0)
        codes, row = codes[keep], row[keep]
        letters = np.bincount(row[codes != 0], minlength=n)
        size = np.bincount(row, minlength=n)
        blocks = -(-size // BLOCK)
        lane_row = np.repeat(np.arange(n), blocks)
        first = np.repeat(np.cumsum(size) - size, blocks)
        within = np.arange(len(lane_row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = first + within * BLOCK
        length = np.minimum(BLOCK, size[lane_row] - within * BLOCK)
        lanes = np.full((BLOCK, len(lane_row)), self.pad, np.uint16)
        lane = np.repeat(np.arange(len(lane_row)), length)
        lanes[np.arange(len(codes)) - np.repeat(start, length), lane] = codes
        phrases = np.zeros((n, len(self.langs)))
        last = np.append(within[1:] == 0, True) if len(within) else np.zeros(0, bool)
        for k, root in enumerate(self.roots):
            count, exits = self._lanes(root, lanes, within > 0)
            phrases[:, k] = np.bincount(lane_row, weights=count + (last & (exits != root)), minlength=n)
        return phrases, size, letters

    def _lanes(self, root, lanes: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrases that end in each lane, state after it) of the parse of whole texts.

        All lanes are parsed at once as if a phrase began with each. A lane that
        `follows` another is then parsed again from that one's last state, until
        both parses are in one state, as they soon are: from there on they agree.
        Lanes that never agree (as in a text of one letter) correct the next lane too;
        after some rounds those are walked one by one in order, each once.
        """
        n, stops = lanes.shape[1], BLOCK // _STRIDE
        states = np.empty((stops, n), self.table.dtype)
        counts = np.empty((stops, n), np.int64)
        at, state = np.arange(n), np.full(n, root, self.table.dtype)
        for turn in range(_ROUNDS):
            count = np.zeros(len(at), np.int64)
            for j in range(stops):
                for symbols in lanes[j * _STRIDE:(j + 1) * _STRIDE, at] if turn else lanes[j * _STRIDE:(j + 1) * _STRIDE]:
                    step = self.table.take(state + symbols)
                    count += step & 3
                    state = step >> 2
                if turn:
                    same = state == states[j, at]
                    counts[j:, at[same]] += (count - counts[j, at])[same]
                    at, state, count = at[~same], state[~same], count[~same]
                states[j, at], counts[j, at] = state, count
                if not len(at):
                    break
            at = at[at + 1 < n] + 1  # whose entry is new
            at = at[follows[at]]
            state = states[-1, at - 1]
            if not turn:
                at, state = at[state != root], state[state != root]
            if not len(at):
                return counts[-1], states[-1]
        pending, k = set(at.tolist()), -1
        for k in sorted(pending):
            while k in pending:
                pending.discard(k)
                state, count = states[-1, k - 1].item(), 0
                for j in range(stops):
                    for symbol in lanes[j * _STRIDE:(j + 1) * _STRIDE, k].tolist():
                        step = self.table.item(state + symbol)
                        count += step & 3
                        state = step >> 2
                    if state == states[j, k]:
                        counts[j:, k] += count - counts[j, k]
                        break
                    states[j, k], counts[j, k] = state, count
                else:
                    if k + 1 < n and follows[k + 1]:
                        k += 1
                        pending.add(k)
        return counts[-1], states[-1]


def _shared_parser(docs: DataFrame, samples: dict[str, str]):
    """The parser, made once by the driver; tasks load its tables (their size is bounded as the samples' is)."""
    return docs.sparkSession.sparkContext.broadcast(Parser(samples))


def _judge(parser: Parser, texts: list[str | None]):
    """(lang or `und`, score, mean phrase length under it) per text."""
    langs = parser.langs
    if not langs:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    phrases, size, letters = parser.parse(texts)
    cost = phrases * parser.bits
    best = cost.argmin(axis=1)  # ties: the first language in code-point order
    rows = np.arange(len(texts))
    least = cost[rows, best]
    if len(langs) > 1:
        cost[rows, best] = np.inf
        score = 1 - least / np.maximum(cost.min(axis=1), 1e-9)
    else:
        score = np.where(letters > 0, 1.0, 0.0)
    known = letters > 0
    names = [langs[b] if k else UNKNOWN for b, k in zip(best, known)]
    return names, np.where(known, score, 0.0), size / np.maximum(phrases[rows, best], 1)


def identify(docs: DataFrame, samples: dict[str, str], text: str = "text",
             key: str = "doc_id") -> DataFrame:
    """(`doc_id`, `lang_pred`, `score`, `phrase_length`) per row of `docs`.

    `lang_pred` is a language of `samples`, or `und` with score 0 where the text
    is null, empty or has no letter, or no language was learned. `score` is the
    margin 1 - cost/second cost (0 to 1; 1 where only one language is known);
    ties go to the first language in code-point order. A text is parsed whole;
    its lanes of `BLOCK` letters are joined to the parse of the whole text.
    Repeated rows give repeated results; other columns are not read.
    """
    shared = _shared_parser(docs, samples)

    def run(batches):
        parser = shared.value
        for b in row_slices(batches, text):
            names, score, length = _judge(parser, b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()),
                 pa.array(length, pa.float64())], names=[key, "lang_pred", "score", "phrase_length"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double, phrase_length double")


def keep_identified(docs: DataFrame, samples: dict[str, str], min_phrase: float = 2.0,
                    text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose text is in a learned language.

    Rejected: `und`, and texts whose phrases under the best language have fewer
    than `min_phrase` symbols on average, as in a script that no sample has (a
    text of one letter per phrase matches nothing). Without samples no row is
    judged and all stay.
    """
    if not samples:
        return docs
    shared = _shared_parser(docs, samples)

    def run(batches):
        parser = shared.value
        for b in row_slices(batches, text):
            names, _, length = _judge(parser, b.column(text).to_pylist())
            yield b.filter(pa.array([x != UNKNOWN and m >= min_phrase for x, m in zip(names, length)],
                                    pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

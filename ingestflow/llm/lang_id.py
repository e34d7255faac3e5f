"""Language identification by cross-parsing entropy (operator 5).

For each language a suffix automaton is built over a bounded sample of its
labelled texts.  A text is cut greedily into the longest phrases that occur in
the sample; the language that needs fewest phrases a character wins.  The
automaton with its restart rule (a failed match starts the next phrase) is
tabulated, so many texts are parsed at once, one character a step.  Every letter
of the samples is a symbol: steps on the most frequent ones are a table, those on
all others a sorted list.  A character that a sample lacks is a phrase of its own.

Texts are lower-cased; every run of characters that are not letters is one
blank.  Long texts are parsed in blocks of ``BLOCK`` characters; a phrase ends
where its block does, which adds at most one phrase per block, alike for every
language.  All blocks of a text count.

The sample is bounded: ``SAMPLE_DOCS`` different texts a language (those with the
smallest hash, whatever their ids) and
``SAMPLE_CHARS`` characters of them.  The model's size therefore depends on
the number of languages only.

Defined results: a null or empty text, or one without a letter, is ``und``
with score 0; without any labelled text every document is ``und``; ties go to
the language that sorts first; each row gives one result row, repeated rows
and null ids included; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ingestflow.llm.common import hash_sample, worker_state

SAMPLE_DOCS = 64
SAMPLE_CHARS = 24_000
SYMBOLS = 64  # of the table: unknown, blank, and the samples' most frequent letters; rarer ones follow
BLOCK = 2048
LANES = 2048  # blocks parsed at once
UNKNOWN = "und"
# How sharply the score tells the best language from the others.
SHARPNESS = 8.0


def transitions(text: list[int]) -> list[dict[int, int]]:
    """The suffix automaton of ``text``: for each state, the next one by symbol."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return nexts


def suffix_automaton(text: list[int], symbols: int) -> np.ndarray:
    """Transitions (states x symbols, -1 where none) over all substrings of ``text``."""
    return _tabulated(transitions(text), symbols)


def _tabulated(nexts: list[dict[int, int]], symbols: int) -> np.ndarray:
    table = np.full((len(nexts), symbols), -1, np.int32)
    for state, row in enumerate(nexts):
        for c, to in row.items():
            if c < symbols:
                table[state, c] = to
    return table


class Model:
    """Parsers of all languages over one alphabet."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]):
        self.langs = [lang for lang, _ in samples]
        texts = {lang: [_letters(t) for t in parts] for lang, parts in samples}
        seen = Counter(c for parts in texts.values() for t in parts for c in t)
        seen.pop(" ", None)
        ranked = sorted(seen, key=lambda c: (-seen[c], c))
        self.symbol = np.zeros(0x110000, np.int32)
        for c in range(0x110000):
            if not chr(c).isalpha():
                self.symbol[c] = 1
        self.letter = self.symbol == 0
        for i, c in enumerate(ranked):
            self.symbol[ord(c)] = i + 2
        self.tables, self.closed, at = [], [], 0
        # Steps on rarer letters: sorted by state and letter; and where a phrase begins with one.
        self.rare = max(0, len(ranked) + 2 - SYMBOLS)
        steps, begins = [], []
        for lang in self.langs:
            # An unknown symbol between texts, so that no phrase runs over their border.
            text = [s for t in texts[lang] for s in (*self.symbols(t)[0].tolist(), 0)]
            nexts = transitions(text)
            go = _tabulated(nexts, SYMBOLS)
            go[:, 0] = -1
            # One more state, where no phrase is open: before a text and after an unknown symbol.
            closed = len(go)
            go = np.concatenate([go, np.full((1, SYMBOLS), -1, np.int32)])
            fail = go < 0
            start = np.where(go[0] >= 0, go[0], closed)
            to = np.where(fail, start[None, :], go) + at
            # A step is the next row's place, times two, plus one where a phrase ended.
            self.tables.append((to.astype(np.int64) * SYMBOLS << 1) | fail)
            self.closed.append((at + closed) * SYMBOLS)
            if self.rare:
                steps += [((at + state) * self.rare + c - SYMBOLS, (at + next_) * SYMBOLS << 1)
                          for state, row in enumerate(nexts) for c, next_ in row.items() if c >= SYMBOLS]
                begins.append(np.full(self.rare, (at + closed) * SYMBOLS << 1 | 1, np.int64))
                for c, next_ in nexts[0].items():
                    if c >= SYMBOLS:
                        begins[-1][c - SYMBOLS] = (at + next_) * SYMBOLS << 1 | 1
            at += len(go)
        self.table = np.concatenate(self.tables).ravel().astype(
            np.int32 if at * SYMBOLS < 1 << 30 else np.int64) if self.tables else None
        del self.tables
        if self.rare and self.langs:
            steps.sort()
            # One more key than any, so that a search always ends at one.
            self.keys = np.array([k for k, _ in steps] + [np.iinfo(np.int64).max], np.int64)
            self.steps = np.array([v for _, v in steps] + [0], self.table.dtype)
            self.begins = np.array(begins, self.table.dtype)

    def symbols(self, text: str) -> tuple[np.ndarray, bool]:
        """The text's symbols, blanks joined and trimmed, and whether it has a letter."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        has = bool(self.letter[codes].any())
        s = self.symbol[codes]
        blank = s == 1
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        s = s[keep]
        return s[int(len(s) > 0 and s[0] == 1):], has

    def step(self, place: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next row's place, times two, plus one where a phrase ended; languages x texts."""
        rare = np.flatnonzero(symbols >= SYMBOLS) if self.rare else ()
        if not len(rare):
            return self.table[place + symbols]
        out = self.table[place + np.where(symbols < SYMBOLS, symbols, 0)]
        letter = symbols[rare] - SYMBOLS
        key = place[:, rare].astype(np.int64) // SYMBOLS * self.rare + letter
        at = np.searchsorted(self.keys, key)
        out[:, rare] = np.where(self.keys[at] == key, self.steps[at], self.begins[:, letter])
        return out

    def phrases(self, rows: list[np.ndarray]) -> np.ndarray:
        """Phrases that each language needs for each row of symbols."""
        out = np.zeros((len(rows), len(self.langs)), np.int64)
        blocks = [(i, r[a:a + BLOCK]) for i, r in enumerate(rows) for a in range(0, len(r), BLOCK)]
        blocks.sort(key=lambda b: -len(b[1]))
        closed = np.array(self.closed, self.table.dtype)
        for at in range(0, len(blocks), LANES):
            part = blocks[at:at + LANES]
            sizes = np.array([len(b) for _, b in part])
            grid = np.zeros((sizes[0], len(part)), self.table.dtype)
            for k, (_, b) in enumerate(part):
                grid[:len(b), k] = b
            place = np.tile(closed[:, None], (1, len(part)))
            count = np.zeros((len(closed), len(part)), np.int64)
            active = len(part)
            for t in range(sizes[0]):
                while sizes[active - 1] <= t:
                    active -= 1
                step = self.step(place[:, :active], grid[t, :active])
                count[:, :active] += step & 1
                place[:, :active] = step >> 1
            np.add.at(out, [i for i, _ in part], count.T)
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language and score, and whether the language knows more of the text than nothing.

        A text of unknown letters alone is as many phrases as characters.
        """
        langs, scores, known = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        rows, where = [], []
        for i, t in enumerate(texts):
            s, has = self.symbols(t) if t else (None, False)
            if has and self.langs:
                rows.append(s)
                where.append(i)
        if rows:
            need = self.phrases(rows) / np.array([len(r) for r in rows])[:, None]
            best = need.argmin(axis=1)
            low = need.min(axis=1)[:, None]
            share = 1 / ((low / need) ** SHARPNESS).sum(axis=1)
            for i, b, s, n in zip(where, best.tolist(), share.tolist(), low[:, 0].tolist(), strict=True):
                langs[i], scores[i], known[i] = self.langs[b], s, n < 1
        return langs, scores, known

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        return self.judge(texts)[:2]


def _letters(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def _model(samples: tuple) -> Model:
    return worker_state("language model", samples, lambda: Model(samples))


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple:
    """The bounded sample of every language, as the model's parameter."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                F.xxhash64(F.col(text_col).cast("string")).alias("h")) \
        .withColumn("text", F.substring("text", 1, SAMPLE_CHARS))
    kept = hash_sample(rows, "lang", SAMPLE_DOCS, "h")
    out: dict[str, list[str]] = {}
    # Texts are dealt in equal shares, shortest first, so one long text cannot fill the sample.
    for lang in sorted({r.lang for r in kept}):
        texts = sorted((_letters(r.text) for r in kept if r.lang == lang), key=lambda t: (len(t), t))
        left, parts = SAMPLE_CHARS, []
        for i, t in enumerate(texts):
            parts.append(t[:left // (len(texts) - i)])
            left -= len(parts[-1])
        if any(parts):
            out[lang] = [p for p in parts if p]
    return tuple((lang, tuple(parts)) for lang, parts in out.items())


def identify(docs: DataFrame, samples: tuple, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts):
        langs, scores = _model(samples).predict(
            [t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    cols = [c for c in docs.columns if c not in ("lang_pred", "score")]
    got = docs.select(*cols, predicted(F.col(text_col).cast("string")).alias("__lang"))
    return got.select(*cols, "__lang.lang_pred", "__lang.score")


def of_known_language(docs: DataFrame, samples: tuple, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose best language needs fewer phrases than for letters all unknown."""
    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        return pd.Series(_model(samples).judge([t if isinstance(t, str) else None for t in texts])[2],
                         dtype=bool)

    return docs.where(known(F.col(text_col).cast("string")))


def training_rows(docs: DataFrame) -> DataFrame:
    """Documents that the registered query may learn from."""
    return docs.where(~held_out(docs))


def held_out(docs: DataFrame):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))

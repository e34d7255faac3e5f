"""Transcript parsing by a hidden Markov model over lines (operator 3).

A transcript is one text whose lines begin or continue a speaker's turn.  The
hidden state of a line is a role and whether the line begins a turn; what is
seen of a line is its speaker marker (``User:``, ``### Assistant``, ``[system]``,
a name) and its form: how long it is, how it ends, and how it starts.
Viterbi finds the roles; the turns are then rendered in one canonical form.

The model is counted, with one added to each count, from at most
``TRAIN_CONVERSATIONS`` conversations with known roles (those with the
smallest hash of their id), each written as a transcript in every marker style.

Very long conversations are parsed in pieces of ``PIECE_TURNS`` turns, and a
piece that holds more than ``PIECE_ROWS`` rows (repeated turn numbers) is
dealt into several by a hash of its rows, so no conversation is ever gathered
whole.  A text of any length is parsed whole.

Defined results: a null or empty transcript has no turns and renders as ``""``;
turns without a role are written with the marker of ``user``; rows without a
text are turns of no lines and are left out of the transcript; rows with equal
turn numbers are ordered by role and text, and rows repeated in full are one
turn; rows without a conversation id form the conversation of id null; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ingestflow.llm.common import Workspace

ROLES = ("system", "user", "assistant")
# States: each role beginning a turn, then each role going on with one.
STATES = [(r, b) for b in (True, False) for r in range(len(ROLES))]
TRAIN_CONVERSATIONS = 200
FORM_DOUBT = 0.4
PIECE_TURNS = 64
PIECE_ROWS = 512

# Marker words of the roles, and the styles that transcripts are written in.
WORDS = {"system": ("system", "instructions", "context"),
         "user": ("user", "human", "customer", "question", "q", "prompter", "client", "you"),
         "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model", "gpt", "chatbot")}
ROLE_OF = {w: i for i, r in enumerate(ROLES) for w in WORDS[r]}
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("SYSTEM: ", "Human: ", "AI: "),
    ("### System\n", "### User\n", "### Assistant\n"),
    ("[system] ", "[user] ", "[assistant] "),
    ("**System:** ", "**Customer:** ", "**Agent:** "),
    ("Context: ", "Q: ", "A: "),
    ("System: ", "Anna: ", "Ben: "),
)
MARKER = re.compile(
    r"^\s*(?:#{1,6}\s*([A-Za-z]\w{0,19})\s*:?\s*$"
    r"|\[([A-Za-z]\w{0,19})\]:?\s*|<\|?([A-Za-z]\w{0,19})\|?>\s*"
    r"|\*\*([A-Za-z]\w{0,19}):?\*\*:?\s*|>?\s*([A-Za-z]\w{0,19})\s*:(?:\s+|$))")
# What a marker says: nothing, a role, a name not seen before the last one's change, the last name again.
NONE, NAME_NEW, NAME_SAME = 0, 4, 5
SIZES = (6, 5, 4, 4)  # values of each feature


def features(lines: list[str]) -> list[tuple[int, int, int, int]]:
    """Marker, length, ending and start of each line."""
    out, last = [], None
    for line in lines:
        m = MARKER.match(line)
        word = next(filter(None, m.groups()), "").lower() if m else ""
        if not word:
            marker = NONE
        elif word in ROLE_OF:
            marker = 1 + ROLE_OF[word]
        else:
            marker = NAME_SAME if word == last else NAME_NEW
            last = word
        rest = line[m.end():].strip() if m else line.strip()
        size = min(4, int(math.log2(len(rest) + 1)) // 2)
        end = 0 if not rest else 1 if rest[-1] == "?" else 2 if rest[-1] in ".!" else 3
        start = 0 if not rest else 1 if rest[0].isupper() else 2 if rest[0].isalnum() else 3
        out.append((marker, size, end, start))
    return out


class Model:
    """Log probabilities of first states, steps and features."""

    def __init__(self):
        n = len(STATES)
        self.first = [1.0] * n
        self.step = [[1.0] * n for _ in range(n)]
        self.seen = [[[1.0] * size for size in SIZES] for _ in range(n)]

    def count(self, lines: list[str], states: list[int]) -> None:
        for i, (s, f) in enumerate(zip(states, features(lines), strict=True)):
            if i:
                self.step[states[i - 1]][s] += 1
            else:
                self.first[s] += 1
            for k, v in enumerate(f):
                self.seen[s][k][v] += 1

    def finish(self) -> "Model":
        def logs(row: list[float]) -> list[float]:
            return [math.log(v / sum(row)) for v in row]

        self.first = logs(self.first)
        self.step = [logs(row) for row in self.step]
        # A turn goes on only in its own role.
        for a, (role, _) in enumerate(STATES):
            for b, (next_role, begins) in enumerate(STATES):
                if not begins and role != next_role:
                    self.step[a][b] = -math.inf
        for s, (_, begins) in enumerate(STATES):
            if not begins:
                self.first[s] = -math.inf
        # Line forms differ from source to source: they are trusted less than markers.
        self.seen = [[logs(row) if k == 0 else
                      [math.log((1 - FORM_DOUBT) * v / sum(row) + FORM_DOUBT / len(row)) for v in row]
                      for k, row in enumerate(rows)] for rows in self.seen]
        return self

    def viterbi(self, lines: list[str]) -> list[int]:
        score, back = None, []
        n = range(len(STATES))
        for f in features(lines):
            emit = [sum(rows[k][v] for k, v in enumerate(f)) for rows in self.seen]
            if score is None:
                score = [self.first[s] + emit[s] for s in n]
                continue
            ways = [max(n, key=lambda a, b=b: score[a] + self.step[a][b]) for b in n]
            score = [score[ways[b]] + self.step[ways[b]][b] + emit[b] for b in n]
            back.append(ways)
        if score is None:
            return []
        path = [max(n, key=score.__getitem__)]
        for ways in reversed(back):
            path.append(ways[path[-1]])
        return path[::-1]


def parse(text: str | None, model: Model) -> list[tuple[str, str]]:
    """(role, text) of a transcript's turns."""
    lines = text.split("\n") if text else []
    turns: list[tuple[str, list[str]]] = []
    for line, s in zip(lines, model.viterbi(lines), strict=True):
        role, begins = STATES[s]
        m = MARKER.match(line) if begins else None
        if begins or not turns:
            turns.append((ROLES[role], []))
        rest = line[m.end():] if m else line
        if rest or not m:
            turns[-1][1].append(rest)
    return [(role, "\n".join(part).strip()) for role, part in turns]


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def transcript(turns: list[tuple[str, str]], style: int) -> tuple[str, list[int]]:
    """Turns written in a marker style, and the states of its lines."""
    lines, states = [], []
    for role, text in turns:
        r = ROLES.index(role) if role in ROLES else 1
        written = (STYLES[style % len(STYLES)][r] + text).split("\n")
        lines += written
        states += [r] + [r + len(ROLES)] * (len(written) - 1)
    return "\n".join(lines), states


def pieces(conversations: DataFrame, ws: Workspace) -> DataFrame:
    """``conv_id, piece, part, turns``: bounded runs of turns, in order."""
    piece = F.coalesce(F.floor(F.col("turn") / PIECE_TURNS), F.lit(-1)).cast("long")
    # Rows repeated in full are one before they are gathered.
    rows = ws.write(conversations.where("text is not null")
                    .groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
                    .select("conv_id", piece.alias("piece"), "turn", "role", "text"), "turns")
    parts = ws.write(rows.groupBy("conv_id", "piece").agg(
        F.ceil(F.count("*") / PIECE_ROWS).alias("parts")).where("parts > 1"), "parts")
    dealt = rows.join(parts.select(F.col("conv_id").alias("c"), F.col("piece").alias("p"), "parts"),
                      F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("p")), "left") \
        .withColumn("part", F.pmod(F.xxhash64("turn", "role", "text"), F.coalesce("parts", F.lit(1))))
    return dealt.groupBy("conv_id", "piece", "part").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def _pairs(turns) -> list[tuple[str, str]]:
    return [(t["role"], t["text"]) for t in turns]


def learn(conversations: DataFrame) -> Model:
    """Count the model on a bounded sample of conversations with known roles."""
    known = conversations.where(F.col("conv_id").isNotNull() & F.col("text").isNotNull()
                                & F.col("role").isin(*ROLES) & (F.col("turn") < PIECE_TURNS))
    chosen = known.select("conv_id").distinct().orderBy(F.xxhash64("conv_id"), "conv_id") \
        .limit(TRAIN_CONVERSATIONS)
    kept = known.join(F.broadcast(chosen), "conv_id", "left_semi") \
        .groupBy("conv_id", "turn").agg(F.min(F.struct("role", F.substring("text", 1, 4000).alias("text")))
                                        .alias("t")).select("conv_id", "turn", "t.role", "t.text")
    by: dict[int, list] = {}
    for r in sorted(kept.collect(), key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append((r.role, r.text))
    model = Model()
    for turns in by.values():
        for style in range(len(STYLES)):
            text, states = transcript(turns, style)
            model.count(text.split("\n"), states)
    return model.finish()


def write_transcripts(pieced: DataFrame, style: Column) -> DataFrame:
    """``pieced`` with ``transcript`` and ``line_roles``, the true role of each line."""
    @F.pandas_udf("transcript string, line_roles array<string>")
    def written(turns: pd.Series, styles: pd.Series) -> pd.DataFrame:
        rows = [transcript(_pairs(t), int(s)) for t, s in zip(turns, styles, strict=True)]
        return pd.DataFrame({"transcript": [t for t, _ in rows],
                             "line_roles": [[ROLES[s % len(ROLES)] for s in states] for _, states in rows]})

    return pieced.withColumn("w", written("turns", style)).select(
        *pieced.columns, "w.transcript", "w.line_roles")


def recover(transcripts: DataFrame, model: Model, text_col: str = "transcript") -> DataFrame:
    """``transcripts`` with ``turns array<struct<role, text>>``, ``rendered`` and each line's role."""
    @F.pandas_udf("turns array<struct<role: string, text: string>>, rendered string, "
                  "found_roles array<string>")
    def recovered(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text in part:
                text = text if isinstance(text, str) and text else None
                turns = parse(text, model)
                states = model.viterbi(text.split("\n")) if text else []
                rows.append(([{"role": r, "text": t} for r, t in turns], render(turns),
                             [ROLES[STATES[s][0]] for s in states]))
            yield pd.DataFrame(rows, columns=["turns", "rendered", "found_roles"])

    cols = [c for c in transcripts.columns if c not in ("turns", "rendered", "found_roles")]
    got = transcripts.select(*cols, recovered(F.col(text_col).cast("string")).alias("__r"))
    return got.select(*cols, "__r.turns", "__r.rendered", "__r.found_roles")

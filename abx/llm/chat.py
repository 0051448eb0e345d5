"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

States are ROLES. A line shows a speaker marker (``User:``, ``### Assistant``, ``<|system|>``, ...),
its length and whether it asks; the row it stands in shows how many lines it has. Between the rows
of a transcript the role moves by learned chances; inside a row it moves freely at a marker and
hardly otherwise. ``learn`` counts all of this over rows whose role is known; ``parse`` finds the
best path by Viterbi, without reading a role, and writes one turn per run of lines of a role in a
row: ``<|role|>``, the lines without their markers, ``<|end|>``.

A transcript may be as long as the table. Rows are sorted by range of (transcript, turn), which
splits a long one over tasks, and cut off from lineage there. A row, and a run of rows, is a small
matrix of best scores from role to role; every task reports those of its first and last transcript
(two rows a task), the driver links them across tasks, and every task then walks its own rows from
the scores that enter to the role that must come out. No transcript is gathered in one place.

Defined results: a null text is one empty line; rows without a transcript id are transcripts of
their own; null turns come first; rows equal in transcript and turn go by text; repeated rows are
turns of their own; rows with other roles, or none, are not learned from; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.llm.common import materialize

ROLES = ("system", "user", "assistant")
# Speaker names that a marker may carry (fixed values).
NAMES = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "question", "q", "customer", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "gpt", "agent"),
}
_ROLE_OF = {name: i for i, role in enumerate(ROLES) for name in NAMES[role]}
_NAMES = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
_MARKER = re.compile(rf"\s*(?:<\|({_NAMES})\|>|\[({_NAMES})\]\s*:?|#{{1,4}}\s*({_NAMES})\s*:?\s*$|\**({_NAMES})\**\s*:\**)\s*", re.I)
MARKER_HOLDS = 0.9
STAYS = 0.9999
LENGTHS = 16
ROW_LINES = 10
FEATURES = LENGTHS + 2 + ROW_LINES


def marker(line: str) -> tuple[int, int]:
    """Role named by the line's speaker marker (-1 if none) and the length of the marker."""
    m = _MARKER.match(line)
    if not m:
        return -1, 0
    return _ROLE_OF[next(g for g in m.groups() if g).lower()], m.end()


def observe(text: str | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lines of a row, their marker roles, and their features as columns of FEATURES counts."""
    lines = (text or "").split("\n")
    said = np.asarray([marker(x)[0] for x in lines])
    seen = np.zeros((len(lines), FEATURES))
    for i, x in enumerate(lines):
        seen[i, min(len(x).bit_length(), LENGTHS - 1)] = 1
        seen[i, LENGTHS + x.rstrip().endswith("?")] = 1
    seen[0, LENGTHS + 2 + min(len(lines).bit_length(), ROW_LINES - 1)] = 1
    return lines, said, seen


@dataclass
class Model:
    """log probabilities: first role, role after role between rows, and features by role."""

    first: np.ndarray
    between: np.ndarray
    feature: np.ndarray

    def emissions(self, said: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """(lines, roles) log likelihoods."""
        out = seen @ self.feature.T
        n = len(ROLES)
        for i in np.flatnonzero(said >= 0):
            out[i] += np.log((1 - MARKER_HOLDS) / (n - 1))
            out[i, said[i]] += np.log(MARKER_HOLDS) - np.log((1 - MARKER_HOLDS) / (n - 1))
        return out

    def inside(self, marked: bool) -> np.ndarray:
        """Moves between two lines of a row, the second of which has a marker or not."""
        n = len(ROLES)
        if marked:
            return np.full((n, n), -np.log(n))
        out = np.full((n, n), np.log((1 - STAYS) / (n - 1)))
        np.fill_diagonal(out, np.log(STAYS))
        return out


def _model(counts: np.ndarray) -> Model:
    """From summed counts: first roles, role pairs and features, each smoothed by one."""
    n = len(ROLES)
    first = counts[:n] + 1
    between = counts[n : n + n * n].reshape(n, n) + 1
    feature = counts[n + n * n :].reshape(n, FEATURES) + 1
    parts = [feature[:, :LENGTHS], feature[:, LENGTHS : LENGTHS + 2], feature[:, LENGTHS + 2 :]]
    shares = np.hstack([p / p.sum(1, keepdims=True) for p in parts])
    return Model(np.log(first / first.sum()), np.log(between / between.sum(1, keepdims=True)), np.log(shares))


def _best(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best scores over one step after another (matrix product with max for sum and sum for product)."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def _row_steps(model: Model, text: str | None) -> tuple[list[str], np.ndarray, list[np.ndarray], np.ndarray]:
    """Lines, marker roles, scores of moving into each line but the first, and emissions."""
    lines, said, seen = observe(text)
    emit = model.emissions(said, seen)
    return lines, said, [model.inside(said[i] >= 0) + emit[i] for i in range(1, len(lines))], emit


def _row_matrix(model: Model, text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Best scores into the row's last line from the role before the row, and as a first row."""
    _, _, steps, emit = _row_steps(model, text)
    enter, start = model.between + emit[0], np.diag(model.first + emit[0])
    start[~np.eye(len(ROLES), dtype=bool)] = -np.inf
    for s in steps:
        enter, start = _best(enter, s), _best(start, s)
    return enter, start.max(0)


def sort_rows(df: DataFrame, id_col: str, turn_col: str, text_col: str, extra: list[Column]) -> DataFrame:
    """(conv, turn, text, ...) sorted by range of (conv, turn, text), checkpointed with its partitions."""
    rows = df.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), F.col(text_col).cast("string").alias("text"), *extra)
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("n", F.monotonically_increasing_id())
    order = ["conv", "turn", "h", "n"]
    return materialize(rows.repartitionByRange(*order).sortWithinPartitions("conv", "turn", "text", "n").drop("h", "n"))


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of rows of one transcript; rows without an id are runs of their own."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        conv = pdf.conv
        new = (conv.ne(conv.shift()) | conv.isna()).to_numpy().copy()
        new[0] = not held or pd.isna(conv.iloc[0]) or held[-1].conv.iloc[-1] != conv.iloc[0]
        cuts = [*np.flatnonzero(new).tolist(), len(pdf)]
        if cuts[0] > 0:
            held.append(pdf.iloc[: cuts[0]])
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held:
                yield pd.concat(held, ignore_index=True)
            held = [pdf.iloc[a:b]]
    if held:
        yield pd.concat(held, ignore_index=True)


def learn(rows: DataFrame) -> Model:
    """The model from sorted rows (conv, turn, text, role); a null role is not learned from."""
    n = len(ROLES)
    place = {r: i for i, r in enumerate(ROLES)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(n + n * n + n * FEATURES)
        edge: list[tuple] = []
        for seg in _segments(batches):
            roles = [place.get(r, -1) for r in seg.role]
            edge = [edge[0] if edge else (seg.conv.iloc[0], roles[0]), (seg.conv.iloc[0], roles[-1])]
            if len(edge) == 2 and roles[0] >= 0:
                counts[roles[0]] += 1  # taken back by the driver if the transcript began in the task before
            for a, b in zip(roles, roles[1:], strict=False):
                if a >= 0 and b >= 0:
                    counts[n + a * n + b] += 1
            for r, text in zip(roles, seg.text, strict=True):
                if r >= 0:
                    at = n + n * n + r * FEATURES
                    counts[at : at + FEATURES] += observe(text)[2].sum(0)
        if edge:
            yield pd.DataFrame(
                {"pid": [TaskContext.get().partitionId()], "counts": [counts.tolist()], "first_conv": [_text(edge[0][0])], "first_role": [edge[0][1]], "last_conv": [_text(edge[1][0])], "last_role": [edge[1][1]]}
            )

    got = rows.select("conv", "text", "role").mapInPandas(run, "pid int, counts array<double>, first_conv string, first_role int, last_conv string, last_role int")
    total, last = np.zeros(n + n * n + n * FEATURES), (None, -1)
    for r in sorted(got.collect(), key=lambda r: r.pid):  # one row a task
        total += np.asarray(r.counts)
        if r.first_conv is not None and r.first_conv == last[0] and r.first_role >= 0:
            total[r.first_role] -= 1
            if last[1] >= 0:
                total[n + last[1] * n + r.first_role] += 1
        last = (r.last_conv, r.last_role)
    return _model(total)


def _text(conv) -> str | None:
    return None if pd.isna(conv) else str(conv)


def _link(edges: list) -> dict[int, tuple]:
    """For each task: scores that enter its first transcript (None: it begins there) and the role in
    which its last transcript must leave (None: it ends there). ``edges`` has one row a task."""
    enter, leave, alphas = {}, {}, {}
    last_conv, alpha = None, None
    for e in edges:
        goes_on = e.first_conv is not None and e.first_conv == last_conv
        enter[e.pid] = alpha if goes_on else None
        n = len(ROLES)
        first = (alpha[:, None] + np.reshape(e.first_enter, (n, n))).max(0) if goes_on else np.asarray(e.first_start)
        alphas[e.pid] = first
        alpha = first if e.single else np.asarray(e.last_start)
        last_conv = e.last_conv
    following = None
    for e in reversed(edges):
        # The role in which this task's last transcript leaves, from what the next task needs.
        if following is not None and e.last_conv is not None and following[0] == e.last_conv:
            leave[e.pid] = int((enter[following[1]] + following[2]).argmax())
        else:
            leave[e.pid] = None
        if enter[e.pid] is None:
            following = None
            continue
        n = len(ROLES)
        matrix = np.reshape(e.first_enter, (n, n))
        end = leave[e.pid] if e.single and leave[e.pid] is not None else int(alphas[e.pid].argmax())
        following = (e.first_conv, e.pid, matrix[:, end])
    return {e.pid: (enter[e.pid], leave[e.pid]) for e in edges}


def _decode(model: Model, texts: list, enter: np.ndarray | None, leave: int | None) -> list[tuple[list[str], np.ndarray, np.ndarray]]:
    """(lines, marker roles, roles) of each row on the best path."""
    rows, score, back = [], enter, []
    for text in texts:
        lines, said, steps, emit = _row_steps(model, text)
        for i in range(len(lines)):
            if score is None:
                score = model.first + emit[0]
                back.append(None)
                continue
            s = score[:, None] + (model.between + emit[0] if i == 0 else steps[i - 1])
            back.append(s.argmax(0))
            score = s.max(0)
        rows.append((lines, said))
    role = int(score.argmax()) if leave is None else leave
    path = np.zeros(len(back), int)
    for i in range(len(back) - 1, -1, -1):
        path[i] = role
        if i and back[i] is not None:
            role = int(back[i][role])
    out, at = [], 0
    for lines, said in rows:
        out.append((lines, said, path[at : at + len(lines)]))
        at += len(lines)
    return out


def turns_of(lines: list[str], said: np.ndarray, roles: np.ndarray) -> list[tuple[str, str]]:
    """(role, text) of each run of lines of one role that a marker or the row's start opens."""
    out: list[list] = []
    for line, mark, role in zip(lines, said, roles, strict=True):
        body = line[marker(line)[1] :] if mark == role else line
        if out and out[-1][0] == role:
            out[-1][1].append(body)
        else:
            out.append([role, [body]])
    return [(ROLES[r], "\n".join(body).strip()) for r, body in out]


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>"


def parse(rows: DataFrame, model: Model) -> DataFrame:
    """(conv, turn, part, role, text, rendered) of every recovered turn of sorted rows (conv, turn, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, first, last = shared.value, None, None
        for seg in _segments(batches):
            enter = start = None
            for text in seg.text:
                e, s = _row_matrix(m, text)
                enter = e if enter is None else _best(enter, e)
                start = s if start is None else (start[:, None] + e).max(0)
            last = (_text(seg.conv.iloc[0]), enter, start)
            single = first is None
            first = first or last
        if first:
            yield pd.DataFrame(
                {"pid": [TaskContext.get().partitionId()], "single": [single], "first_conv": [first[0]], "first_enter": [first[1].ravel().tolist()], "first_start": [first[2].tolist()], "last_conv": [last[0]], "last_start": [last[2].tolist()]}
            )

    found = rows.select("conv", "text").mapInPandas(edges, "pid int, single boolean, first_conv string, first_enter array<double>, first_start array<double>, last_conv string, last_start array<double>")
    links = rows.sparkSession.sparkContext.broadcast(_link(sorted(found.collect(), key=lambda r: r.pid)))  # one row a task

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        enter, leave = links.value.get(TaskContext.get().partitionId(), (None, None))
        ahead = None

        def turns(seg: pd.DataFrame, leave: int | None) -> pd.DataFrame:
            out = []
            for turn, (lines, said, roles) in zip(seg.turn, _decode(m, list(seg.text), enter, leave), strict=True):
                for part, (role, text) in enumerate(turns_of(lines, said, roles)):
                    out.append((seg.conv.iloc[0], turn, part, role, text, render(role, text)))
            return pd.DataFrame(out, columns=["conv", "turn", "part", "role", "text", "rendered"])

        for seg in _segments(batches):
            if ahead is not None:
                yield turns(ahead, None)
                enter = None
            ahead = seg
        if ahead is not None:
            yield turns(ahead, leave)

    kind = rows.schema["conv"].dataType.simpleString()
    return rows.select("conv", "turn", "text").mapInPandas(run, f"conv {kind}, turn bigint, part int, role string, text string, rendered string")


def format_chats(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str = "role", learn_from: Column | None = None) -> DataFrame:
    """Recovered turns of all rows: id, turn, part, role, text, rendered. The model learns from the known
    roles of the rows that ``learn_from`` admits (all if not given)."""
    role = F.lower(F.trim(F.col(role_col).cast("string")))
    admitted = role.isin(*ROLES) if learn_from is None else role.isin(*ROLES) & learn_from
    rows = sort_rows(df, id_col, turn_col, text_col, [F.when(admitted, role).alias("role")])
    out = parse(rows, learn(rows))
    return out.select(F.col("conv").alias(id_col), "turn", "part", "role", "text", "rendered")

"""Chat formatting: a hidden Markov model recovers the speaker of every line, then turns are rendered canonically.

Texts are cut into numbered lines. Hidden states are roles; a line shows a speaker marker (or none), how long it is
(blank lines have a bin of their own), whether it is the first of its row, and whether it asks something. A speaker
mostly changes where a row or a marker begins, so these lines have transitions of their own. Probabilities are counts
over labelled rows; a marker speaks for the role it names from the start. Runs of lines of one role inside a row are
turns, so a transcript that stands in one row comes apart.

Viterbi runs in blocks of a conversation: a block's effect on the best path is a small max-plus matrix, the matrices of
a conversation's blocks are folded in order, and every block is then decoded on its own between a known entry and exit.
A conversation with a third of all lines is thus many tasks, with the path of an undivided run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions.ranking import prefix_scan
from ..session import materialize

BLOCK = 2048
#: Speaker words at the start of a line, by role.
MARKERS = {"user": ("user", "human", "question", "q", "you", "customer"), "assistant": ("assistant", "ai", "bot", "answer", "a", "model", "agent"),
           "system": ("system", "instruction", "instructions", "prompt")}
_WORD = {w: k + 1 for k, (_, words) in enumerate(sorted(MARKERS.items())) for w in words}
_MARKER = re.compile(r"^[\s#*<|\[\(]*([A-Za-z]{1,12})[\s*|>\]\)]*[:>\]|]\s*")
MARKER_PRIOR = 200  # pseudo-count of a role showing a marker that names it
_FEATURES = ("marker", "words", "first", "asks")
_SIZES = {"marker": len(MARKERS) + 1, "words": 12, "first": 2, "asks": 2}


def observe(text: str, first: bool) -> tuple[int, int, int, int]:
    """Marker class (0: none) and bin of words of a line, whether it is its row's first, and whether it asks."""
    m = _MARKER.match(text)
    marker = _WORD.get(m[1].lower(), 0) if m else 0
    return (marker, min(11, len(text.split()).bit_length()), int(first), int("?" in text))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row as its lines, numbered from 0; the other columns (_others) stay with the first one."""
    for batch in batches:
        for b in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            parts = [(t or "").split("\n") for t in b.column("text").to_pylist()]
            at = np.repeat(np.arange(b.num_rows), [len(x) for x in parts])
            n = np.concatenate([np.arange(len(x)) for x in parts])
            text = [x for lines in parts for x in lines]
            cols = zip(*map(observe, text, (n == 0).tolist()), strict=True)
            given = {c: b.column(c).take(pa.array(at)) for c in b.schema.names if c not in ("text", "_others")}
            others = b.column("_others").take(pa.array(at, mask=n > 0))
            yield pa.RecordBatch.from_pydict({**given, "_others": others, "text": pa.array(text, pa.string()), "_nth": pa.array(n, pa.int32()),
                                              **{k: pa.array(c, pa.int32()) for k, c in zip(_FEATURES, cols, strict=True)}})


class Model:
    """Log-probabilities of the next role inside a turn (0) and where a row or marker begins (1; its last row is the start
    of a conversation), and of each feature given a role."""

    def __init__(self, roles: list[str], steps: np.ndarray, shown: dict[str, np.ndarray]):
        self.roles = roles
        self.steps = np.log((steps + 0.5) / (steps + 0.5).sum(2, keepdims=True))
        shown = {k: v + 0.5 for k, v in shown.items()}
        for i, role in enumerate(roles):
            if role.lower() in _WORD:
                shown["marker"][i, _WORD[role.lower()]] += MARKER_PRIOR
        # whether a line has a marker depends on how long turns are, so only its kind tells of the role
        self.shown = {k: np.log(v / v[:, k == "marker":].sum(1, keepdims=True)) for k, v in shown.items()}
        self.shown["marker"][:, 0] = 0

    def emissions(self, features: dict[str, np.ndarray]) -> np.ndarray:
        return sum(self.shown[k][:, features[k]].T for k in _FEATURES)

    def moves(self, features: dict[str, np.ndarray]) -> np.ndarray:
        """Which transitions lead to each line."""
        return ((features["first"] > 0) | (features["marker"] > 0)).astype(int)

    def entry(self) -> list[float]:
        """Scores before a first line: only the start is possible."""
        return [*[-1e300] * len(self.roles), 0.0]

    def transfer(self, emissions: np.ndarray, moves: np.ndarray) -> np.ndarray:
        """Best score from each state before a block to each state at its end."""
        best = self.steps[moves[0]] + emissions[0]
        for e, k in zip(emissions[1:], moves[1:], strict=True):
            best = (best[:, :, None] + self.steps[k, :-1][None]).max(1) + e
        return best

    def decode(self, emissions: np.ndarray, moves: np.ndarray, entry: list[float], leave: int = -1) -> list[int]:
        """The best path of a block from the scores before it (with the start's, for a first block); ``leave`` fixes its
        last state. Ties go to the first role."""
        score, back = np.array(entry), []
        for e, k in zip(emissions, moves, strict=True):
            all_ = score[:, None] + self.steps[k, :len(score)]
            at = all_.argmax(0)
            back.append(at)
            score = all_[at, np.arange(len(at))] + e
        state = int(score.argmax()) if leave < 0 else leave
        path = [state]
        for at in reversed(back[1:]):
            state = int(at[state])
            path.append(state)
        return path[::-1]


def ordered(turns: DataFrame) -> DataFrame:
    """The lines of ``turns``: number in the conversation (_rank, from 1), block, row (_row), number in the row (_nth), features;
    columns of ``turns`` but conv_id, turn, role and text stand in _others of a row's first line.

    A null conv_id is a conversation of its own for each row. Rows of one turn number follow each other by a hash of
    their text; null turn numbers come first.
    """
    used = ("conv_id", "turn", "role", "text")
    others = [c for c in turns.columns if c not in used]
    rows = turns.select(*used, F.struct(*(others or [F.lit(0)])).alias("_others"), F.monotonically_increasing_id().alias("_row"), F.xxhash64("text").alias("_tie"))
    rows = rows.withColumn("_lone", F.when(F.col("conv_id").isNull(), F.col("_row")))
    lines = materialize(rows.mapInArrow(_lines, _with(rows.select(*[c for c in rows.columns if c not in ("text", "_others")], "_others", "text"), [("_nth", "int"), *[(k, "int") for k in _FEATURES]])))
    bucket = F.floor(F.coalesce(F.col("turn").cast("double"), F.lit(-1e18)) / 256)
    return prefix_scan(lines, ["conv_id", "_lone"], ["turn", "_tie", "_row", "_nth"], bucket, "_rank").withColumn(
        "_block", ((F.col("_rank") - 1) / BLOCK).cast("int")).drop("_tie")


def _with(df: DataFrame, more: list[tuple[str, str]]) -> StructType:
    """The columns of ``df``, all of which may be null, and ``more``."""
    schema = df.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in more]).schema
    return StructType([StructField(f.name, f.dataType) for f in schema])


def train(lines: DataFrame) -> Model | None:
    """Counts over the ordered lines of rows that have a role and no marker behind their first line (such rows have several
    speakers). All that is collected is one row per pair of roles or role and bin."""
    several = lines.where("_nth > 0 AND marker > 0").select("_row").distinct()
    known = lines.where("role IS NOT NULL").join(several, "_row", "left_anti")
    prev = known.select("conv_id", "_lone", (F.col("_rank") + 1).alias("_rank"), F.col("role").alias("before"))
    pairs = known.select("conv_id", "_lone", "_rank", "role", "_nth").alias("t").join(
        prev.alias("p"), F.col("t.conv_id").eqNullSafe(F.col("p.conv_id")) & F.col("t._lone").eqNullSafe(F.col("p._lone")) & (F.col("t._rank") == F.col("p._rank")), "left")
    moves = (pairs.where("before IS NOT NULL OR t._rank = 1").groupBy("before", "role", (F.col("_nth") == 0).cast("int").alias("opens"))
             .agg(F.count(F.lit(1)).alias("n")).collect())
    roles = sorted({r["role"] for r in moves} | {r["before"] for r in moves if r["before"] is not None})
    if not roles:
        return None
    at = {r: i for i, r in enumerate(roles)}
    steps = np.zeros((2, len(roles) + 1, len(roles)))
    for r in moves:
        steps[r["opens"], at[r["before"]] if r["before"] is not None else len(roles), at[r["role"]]] += r["n"]
    shown = {}
    for k in _FEATURES:
        shown[k] = np.zeros((len(roles), _SIZES[k]))
        # a row counts once for each bin, so that one of many lines does not outweigh all others
        for r in known.select("role", k, "_row").distinct().groupBy("role", k).agg(F.count(F.lit(1)).alias("n")).collect():
            if r["role"] in at:
                shown[k][at[r["role"]], r[k]] = r["n"]
    return Model(roles, steps, shown)


def _features(t) -> dict[str, np.ndarray]:
    return {k: t.column(k).to_numpy(zero_copy_only=False) if isinstance(t, pa.RecordBatch) else t.column(k).to_numpy() for k in _FEATURES}


def _block_matrix(model: Model):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("_rank")
        f = _features(t)
        best = model.transfer(model.emissions(f), model.moves(f))
        return pa.table({"conv_id": t.column("conv_id")[:1], "_block": t.column("_block")[:1], "matrix": pa.array([best.reshape(-1).tolist()], pa.list_(pa.float64()))})
    return run


def _fold(model: Model):
    """Entry scores, the state before and the state at the end of every block of a conversation."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("_block")
        size = len(model.roles)
        mats = [np.array(m.as_py()).reshape(size + 1, size) for m in t.column("matrix")]
        score, entries, back = np.array(model.entry()), [], []
        for k, m in enumerate(mats):
            entries.append(score.tolist())
            all_ = score[:, None] + (m if k == 0 else m[:size])
            back.append(all_.argmax(0))
            score = all_.max(0)
        leave = [int(score.argmax())]
        for b in reversed(back[1:]):
            leave.append(int(b[leave[-1]]))
        leave = leave[::-1]
        return pa.table({"conv_id": t.column("conv_id"), "_block": t.column("_block"), "entry": pa.array(entries, pa.list_(pa.float64())),
                         "prior": pa.array([-1, *leave[:-1]], pa.int32()), "leave": pa.array(leave, pa.int32())})
    return run


def _bare(line: str) -> str:
    m = _MARKER.match(line)
    return line[m.end():] if m and m[1].lower() in _WORD else line


def render(role: str, lines: list[str], opens: bool) -> str:
    """The canonical form of a turn: a role line where the speaker changes, then its lines without markers and trailing blanks."""
    body = "\n".join(_bare(x).rstrip() for x in lines).strip()
    return (f"<|{role}|>\n" if opens else "") + body + "\n"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each row as runs of one role."""
    for b in batches:
        out = {"at": [], "line": [], "role_pred": [], "text": [], "rendered": []}
        for i, lines in enumerate(b.column("lines").to_pylist()):
            for role, run in groupby(lines, key=lambda x: x["role_pred"]):
                run = list(run)
                text = [x["text"] for x in run]
                out["at"].append(i)
                out["line"].append(run[0]["_rank"])
                out["role_pred"].append(role)
                out["text"].append("\n".join(text))
                out["rendered"].append("\n".join(text) if role is None else render(role, text, run[0]["opens"]))
        at = pa.array(out.pop("at"), pa.int64())
        kinds = {"line": pa.int64()}
        yield pa.RecordBatch.from_pydict({**{c: b.column(c).take(at) for c in b.schema.names if c != "lines"},
                                          **{c: pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()}})


def _decoded(model: Model, names: list[str]):
    """Rows arrive sorted by conversation, block and rank; a block may span batches."""
    def solve(t: pa.Table) -> pa.Table:
        conv, block = (t.column(c).to_pylist() for c in ("_key", "_block"))
        f = _features(t)
        emit, moves = model.emissions(f), model.moves(f)
        entry, prior, leave = (t.column(c).to_pylist() for c in ("entry", "prior", "leave"))
        path, before, i = [], [], 0
        while i < t.num_rows:
            j = i
            while j < t.num_rows and conv[j] == conv[i] and block[j] == block[i]:
                j += 1
            states = model.decode(emit[i:j], moves[i:j], entry[i] if entry[i] is not None else model.entry(), -1 if leave[i] is None else leave[i])
            before += [-1 if prior[i] is None else prior[i], *states[:-1]]
            path += states
            i = j
        opens = [s != b for s, b in zip(path, before, strict=True)]
        return t.select(names).append_column("role_pred", pa.array([model.roles[s] for s in path], pa.string())).append_column("opens", pa.array(opens, pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            key = list(zip(t.column("_key").to_pylist(), t.column("_block").to_pylist(), strict=True))
            cut = next((i for i in range(len(key) - 1, 0, -1) if key[i] != key[i - 1]), 0)
            held = t.slice(cut)
            if cut:
                yield from solve(t.slice(0, cut)).to_batches()
        if held is not None and held.num_rows:
            yield from solve(held).to_batches()
    return run


def format_chats(turns: DataFrame, learn: Column | None = None) -> DataFrame:
    """The turns in ``turns`` (conv_id, turn, text, role): every row once per run of its lines that have one speaker, with the
    run as text, line (the number of its first line in the conversation), role_pred and rendered.

    Rendered turns of a conversation in order are its transcript: a role line where the speaker changes, then the
    lines with speaker markers and trailing blanks removed. Roles are learned from the rows where ``learn`` holds (all,
    if None) and are never an input of a prediction. Null text is one empty line; without any known role, role_pred
    is null and rendered the bare text. Every row stays, repeated ones too; an empty table gives no rows. Columns of
    the added names are replaced; other columns pass through.
    """
    added = ("line", "role_pred", "rendered")
    names = [c for c in turns.columns if c.lower() not in added]
    teaches = F.coalesce(learn, F.lit(False)) if learn is not None else F.lit(True)
    rows = turns.select(*names, teaches.alias("_learn"))
    lines = materialize(ordered(rows))
    learns = lines.where("_nth = 0 AND _others._learn").select("_row")
    model = train(lines.join(learns, "_row", "left_semi"))
    keep = ["conv_id", "turn", "role", "_row", "_nth", "_rank", "_others", "text"]
    if model is None:
        return _joined(lines.select(*keep).withColumns({"role_pred": F.lit(None).cast("string"), "opens": F.lit(False)}), names)
    long_ = lines.where(f"_rank > {BLOCK}").select("conv_id").distinct()
    parts = lines.where("conv_id IS NOT NULL").join(long_, "conv_id", "left_semi").select("conv_id", "_block", "_rank", *_FEATURES)
    key = lines.schema["conv_id"].dataType.simpleString()
    mats = parts.groupBy("conv_id", "_block").applyInArrow(_block_matrix(model), f"conv_id {key}, _block int, matrix array<double>")
    known = mats.groupBy("conv_id").applyInArrow(_fold(model), f"conv_id {key}, _block int, entry array<double>, prior int, leave int")
    full = (lines.withColumn("_key", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.concat(F.lit("n"), F.col("_lone").cast("string"))))
            .join(known, ["conv_id", "_block"], "left").select(*keep, "_key", "_block", *_FEATURES, "entry", "prior", "leave"))
    dealt = full.repartition("_key", "_block").sortWithinPartitions("_key", "_block", "_rank")
    schema = _with(lines.select(*keep), [("role_pred", "string"), ("opens", "boolean")])
    return _joined(dealt.mapInArrow(_decoded(model, keep), schema), names)


def _joined(lines: DataFrame, names: list[str]) -> DataFrame:
    """Decoded lines as turns with the columns ``names`` of their rows; a group is one row's lines."""
    whole = lines.groupBy("_row").agg(
        F.first("conv_id").alias("conv_id"), F.first("turn").alias("turn"), F.first("role").alias("role"), F.first("_others", ignorenulls=True).alias("_others"),
        F.array_sort(F.collect_list(F.struct("_nth", "_rank", "role_pred", "opens", "text"))).alias("lines"))
    schema = _with(whole.drop("lines"), [("line", "bigint"), ("role_pred", "string"), ("text", "string"), ("rendered", "string")])
    cols = [F.col(c) if c in ("conv_id", "turn", "role", "text") else F.col(f"_others.{c}").alias(c) for c in names]
    return whole.mapInArrow(_turns, schema).select(*cols, "line", "role_pred", "rendered")

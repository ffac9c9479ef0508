"""Chat formatting: speaker roles by a hidden Markov model, then canonical turns.

A transcript is a sequence of segments: turns, and within the text of a row the stretches that
begin at lines with a speaker marker (an unmarked line goes on with what stands before it; a text
without marked lines is one segment).  Neighbouring segments of a row that get the same role are
one turn, so a raw text gives a turn for each change of speaker.  The hidden state is
the speaker's role; a segment emits its speaker marker and line features, independent given the
role.  Transition and emission counts come from all labelled conversations of the training part,
added up by Spark into a table whose size is fixed by the feature values, and are smoothed.
Roles are recovered per conversation by Viterbi in log space; markers are cut off and each turn
is rendered canonically.

Conversations are dealt by id and sorted by turn, and each streams through Viterbi: whenever all
roles' best paths share a past, that past is emitted and forgotten, so a very long conversation
holds only the stretch that is still open.

Defined results: a null text is an empty turn; a null turn sorts first; repeated (id, turn) rows
are turns of their own, in order of their text; rows with a null id form one conversation;
unlabelled or unknown roles teach nothing, nor do rows of several segments (their label is not that
of each); within a text a bare word on its line, or a heading, is a marker only with a colon or
``>``; without labelled rows every role is ``user``; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, rows_in

ROLES = ("system", "user", "assistant")
# Speaker markers that transcripts use, by role (fixed values).
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "me", "question", "q", "customer", "prompter"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "gpt", "model", "agent"),
}
_MARKER = (r"(?i)^\s*(?:<\|(?:im_start\|>)?\s*|\[|#{1,6}\s*|\*\*)?("
           + "|".join(w for words in MARKERS.values() for w in words) + r")(?:\|>|\]|\*\*)?\s*(?::|>|\n|\]|\|>)\s*")
# A line within a text that begins a segment: stricter than at its start, where a bare word will do.
_WORDS = "(?:" + "|".join(w for words in MARKERS.values() for w in words) + ")"
_LINE = (r"(?im)^(?= {0,3}(?:(?:<\|(?:im_start\|>)?[ \t]*|\[|\*\*)" + _WORDS + r"(?:\|>|\]|\*\*)?[ \t]*(?::|>|\r?\n|\]|\|>)"
         r"|(?:#{1,6}[ \t]*)?" + _WORDS + r"[ \t]*[:>]))")
FEATURES = ("marker", "place", "length", "lines", "tail", "mark")
SMOOTHING = 0.5
SURE = -1000.0  # log-probability of another role than a marked line names
COMMIT = 512  # open segments that trigger a look for a shared past


def marker_of(word: Column) -> Column:
    out = F.lit("none")
    for role, words in MARKERS.items():
        out = F.when(word.isin(*words), F.lit(role)).otherwise(out)
    return out


def line_features(body: Column, word: Column, first: Column) -> list[Column]:
    """The observed features of a segment (its text without the marker, and the marker's word),
    as short strings."""
    lines = F.length(body) - F.length(F.replace(body, F.lit("\n"))) + 1
    tail = F.substring(body, -1, 1)
    return [
        marker_of(word).alias("marker"),
        F.when(first, F.lit("first")).otherwise(F.lit("later")).alias("place"),
        F.floor(3 * F.log2(F.length(body) + 1)).cast("string").alias("length"),
        F.least(lines, F.lit(12)).cast("string").alias("lines"),
        F.when(tail == "?", "?").when(tail == ".", ".").when(tail == "", "empty").otherwise("other").alias("tail"),
        F.when(body.contains("```"), "code").when(body.rlike(r"(?m)^\s*(?:[-*]|\d+\.)\s"), "list").otherwise("plain").alias("mark"),
    ]


def segments_of(df: DataFrame, id_col: str, turn_col: str, text_col: str) -> DataFrame:
    """(id, turn, given, segments array<struct<text, features>>) per row, ``place`` told by the
    conversation's smallest turn.  The segments travel as one row, so those of repeated rows
    never mix."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                     *([F.col("role").cast("string").alias("given")] if "role" in df.columns else [F.lit(None).cast("string").alias("given")]))
    starts = rows.groupBy("id").agg(F.min("turn").alias("least")).withColumnRenamed("id", "_id")
    joined = rows.join(starts, rows["id"].eqNullSafe(starts["_id"]), "left")
    first = F.col("turn").eqNullSafe(F.col("least"))
    cut = F.transform(F.split("text", _LINE), lambda t, k: F.struct(
        t.alias("text"), F.trim(F.regexp_replace(t, _MARKER, "")).alias("body"),
        F.lower(F.regexp_extract(t, _MARKER, 1)).alias("word"), (first & (k == 0)).alias("first")))
    segments = F.transform(cut, lambda x: F.struct(x["text"].alias("text"), *line_features(x["body"], x["word"], x["first"])))
    return joined.select("id", "turn", "given", segments.alias("segments"))


def training_part(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def learn(segments: DataFrame) -> dict[tuple, float]:
    """Counts of the training part: ("emit", feature, value, role) and ("move", before, role)."""
    known = (segments.filter(training_part(F.col("id")) & F.col("given").isin(*ROLES)).filter(F.size("segments") == 1)
             .select("id", "turn", "given", F.inline("segments")))
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("what"), F.col(f).alias("value")) for f in FEATURES])).alias("c")
    emitted = known.select("given", cells).groupBy("c.what", "c.value", "given").agg(F.count(F.lit(1)).alias("n"))
    # the role of the turn before, by a join on its number: no window holds a conversation
    here = known.select("id", "turn", "given", "place")
    before = known.select(F.col("id").alias("_id"), (F.col("turn") + 1).alias("_turn"), F.col("given").alias("was"))
    moves = (here.join(before, (here["id"] == before["_id"]) & (here["turn"] == before["_turn"]), "left")
             .withColumn("was", F.when(F.col("place") == "first", F.lit("start")).otherwise(F.col("was"))).filter("was is not null")
             .groupBy("was", "given").agg(F.count(F.lit(1)).alias("n")))
    counts = {("emit", r["what"], r["value"], r["given"]): float(r["n"]) for r in emitted.collect()}
    counts.update({("move", r["was"], r["given"]): float(r["n"]) for r in moves.collect()})
    return counts


class Model:
    def __init__(self, counts: dict[tuple, float]):
        self.empty = not counts
        self.move, self.emit = {}, {}
        for was in ("start", *ROLES):
            n = sum(counts.get(("move", was, r), 0.0) for r in ROLES)
            for r in ROLES:
                self.move[was, r] = math.log((counts.get(("move", was, r), 0.0) + SMOOTHING) / (n + SMOOTHING * len(ROLES)))
        for f in FEATURES:
            values = {k[2] for k in counts if k[0] == "emit" and k[1] == f}
            for r in ROLES:
                n = sum(counts.get(("emit", f, v, r), 0.0) for v in values) + SMOOTHING * (len(values) + 1)
                for v in values:
                    self.emit[f, v, r] = math.log((counts.get(("emit", f, v, r), 0.0) + SMOOTHING) / n)
                self.emit[f, None, r] = math.log(SMOOTHING / n)
        if counts:  # a marker that names its speaker is evidence in itself, also where training has none
            for named in ROLES:
                for r in ROLES:
                    self.emit["marker", named, r] = self.emit.get(("marker", named, r), math.log(0.9 if r == named else 0.05))
        for named in ROLES:  # in a text of several segments the marked lines tell their speakers
            for r in ROLES:
                self.emit["marker", "line " + named, r] = 0.0 if r == named else SURE

    def score(self, observed: tuple, role: str) -> float:
        return sum(self.emit.get((f, v, role), self.emit[f, None, role]) for f, v in zip(FEATURES, observed))


class Viterbi:
    """The best roles of one conversation, given out as they are settled."""

    def __init__(self, model: Model):
        self.model, self.best, self.back = model, None, []

    def add(self, observed: tuple) -> list[str]:
        m = self.model
        if self.best is None:
            self.best = {r: m.move["start", r] + m.score(observed, r) for r in ROLES}
            self.back.append({r: None for r in ROLES})
        else:
            came = {r: max(ROLES, key=lambda q: self.best[q] + m.move[q, r]) for r in ROLES}
            self.best = {r: self.best[came[r]] + m.move[came[r], r] + m.score(observed, r) for r in ROLES}
            self.back.append(came)
        return self.settled() if len(self.back) % COMMIT == 0 else []

    def settled(self) -> list[str]:
        at, live = len(self.back) - 1, set(ROLES)
        while at > 0 and len(live) > 1:
            live = {self.back[at][r] for r in live}
            at -= 1
        if len(live) > 1 or at == 0:
            return []
        roles = self.trace(at, live.pop())
        self.back = self.back[at + 1:]
        return roles

    def trace(self, at: int, role: str) -> list[str]:
        out = []
        for i in range(at, -1, -1):
            out.append(role)
            role = self.back[i][role]
        return out[::-1]

    def finish(self) -> list[str]:
        return self.trace(len(self.back) - 1, max(ROLES, key=self.best.get)) if self.back else []


class Unlearnt:
    """Every role is ``user``."""

    def add(self, observed: tuple) -> list[str]:
        return ["user"]

    def finish(self) -> list[str]:
        return []


def render(role: str, *texts: str) -> str:
    """A canonical turn: the segments' markers cut off, outer white space trimmed."""
    bodies = [re.sub(_MARKER, "", t, count=1).strip() for t in texts]
    return f"<|{role}|>\n" + "\n".join(b for b in bodies if b) + "\n<|end|>\n"


def format_chat(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> DataFrame:
    """One row per turn: (id, turn, role recovered, rendered canonical turn, line of the row's
    text at which it begins, from 0)."""
    segments = segments_of(df, id_col, turn_col, text_col)
    model = Model(learn(segments))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, path, open_, last, row = (), None, [], None, 0

        def out(roles, end=False):
            """Turns that are complete: one that is settled so far may go on in the next segment."""
            nonlocal last
            done = open_[:len(roles)]
            del open_[:len(roles)]
            turns = []
            for (at, line, text), r in zip(done, roles):
                if last and last[0] == at and last[1] == r:
                    last[3].append(text)
                    continue
                if last:
                    turns.append(last)
                last = (at, r, line, [text])
            if end and last:
                turns.append(last)
                last = None
            return [(i, t, r, render(r, *texts), line) for (i, t, _), r, line, texts in turns]

        for columns in rows_in(batches, "id", "turn", "segments"):
            rows = []
            for i, turn, own in zip(*columns):
                if (i,) != key:
                    if path is not None:
                        rows += out(path.finish(), end=True)
                    key, path = (i,), Unlearnt() if model.empty else Viterbi(model)
                line, row = 0, row + 1
                for x in own:
                    if len(own) == 1 or x["text"].strip():
                        open_.append(((i, turn, row), line, x["text"]))
                        marker, *others = (x[f] for f in FEATURES)
                        rows += out(path.add(("line " * (len(own) > 1 and marker != "none") + marker, *others)))
                    line += x["text"].count("\n")
            if rows:
                yield batch(rows)
        if path is not None:
            yield batch(out(path.finish(), end=True))

    def batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["id", "turn", "role", "rendered", "line"])

    prepare(df.sparkSession)
    dealt = segments.drop("given").repartition("id").sortWithinPartitions("id", "turn", "segments")
    return (dealt.mapInArrow(run, "id long, turn long, role string, rendered string, line int")
            .withColumnsRenamed({"id": id_col, "turn": turn_col}))

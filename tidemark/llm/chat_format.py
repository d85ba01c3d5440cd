"""Chat formatting into budgeted, turn-aligned training windows with a loss mask.

A turn is rendered ``<turn ROLE>TEXT</turn>\\n``; backslash and angle brackets
inside role and text are escaped with a backslash, so no text can look like a
mark and reading back is exact. Prefix sums of the turns' tokens choose how many
turns a window takes; every window after the first repeats the system turn and
as much of the preceding turns as ``history`` tokens allow. The loss mask covers
the texts of assistant turns the first time they appear; repeated turns are
context only.

Rows are sorted by conversation and turn and streamed: a task holds one window,
never a conversation. A conversation is one sequence (its digests cannot be
computed in parts), so a hot conversation is read by one task, in bounded memory.

Defined results: null role or text is empty; a null turn sorts first, ties sort
by role and text; repeated rows are turns of their own; a null conv_id is one
conversation; a turn above the budget gets a window of its own, whole; an empty
table gives no windows; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, text_or_empty

RANKS_PATH = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
BUDGET, HISTORY = 1024, 256
LOSS_ROLE = "assistant"
#: the pattern that the public byte-level vocabularies are cut by (fixed value)
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ESCAPE = re.compile(r"[\\<>]")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.)*)</turn>\n", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and where its escaped text starts and ends."""
    head = f"<turn {escape(role)}>"
    body = escape(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def parse(window: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and end of the escaped text) of every turn of a window."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(window)]


class Windows:
    """Windows of one conversation, turn by turn."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system = None  # (rendered, tokens)
        self.turns: list[tuple[str, int, int, bool]] = []  # rendered, text start, text end, under loss
        self.sums = [0]  # prefix sums of their tokens
        self.repeated = 0  # leading turns that an earlier window had
        self.number = 0

    def add(self, role: str, text: str, tokens: int, rendered: tuple[str, int, int], loss: bool):
        """Take one turn; a window that it does not fit any more is returned."""
        out = None
        if self.number == 0 and not self.turns and self.system is None and role == "system":
            self.system = (rendered[0], tokens)
            return None
        room = self.budget - (self.system[1] if self.system else 0)
        if len(self.turns) > self.repeated and self.sums[-1] + tokens > room:
            out = self.close()
            # the longest run of last turns within the history's tokens that leaves room for this turn
            spare = max(0, min(self.history, room - tokens))
            first = bisect_left(self.sums, self.sums[-1] - spare)
            base = self.sums[first]
            self.turns, self.sums = self.turns[first:], [s - base for s in self.sums[first:]]
            self.repeated = len(self.turns)
        self.turns.append((*rendered, loss))
        self.sums.append(self.sums[-1] + tokens)
        return out

    def close(self):
        """(window number, text, leading repeated turns, turns, tokens, loss spans) or None without new turns."""
        if len(self.turns) <= self.repeated and not (self.system and self.number == 0):
            return None
        parts, spans, at = [], [], 0
        if self.system:
            parts.append(self.system[0])
            at = len(self.system[0])
        for i, (text, start, end, loss) in enumerate(self.turns):
            parts.append(text)
            if loss and i >= self.repeated and end > start:
                spans.append({"start": at + start, "end": at + end})
            at += len(text)
        lead = self.repeated + (1 if self.system and self.number else 0)
        tokens = self.sums[-1] + (self.system[1] if self.system else 0)
        out = (self.number, "".join(parts), lead, len(parts), tokens, spans)
        self.number += 1
        return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_NAMES = ["conv_id", "window", "text", "n_repeated", "n_turns", "n_tokens", "loss_spans"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), _SPANS]
_SCHEMA = (
    "conv_id bigint, window bigint, text string, n_repeated bigint, n_turns bigint, n_tokens bigint, "
    "loss_spans array<struct<start:bigint,end:bigint>>"
)


def load_ranks(path: str = RANKS_PATH) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def format_windows(
    turns: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    loss_role: str = LOSS_ROLE,
    ranks_path: str = RANKS_PATH,
) -> DataFrame:
    """Windows of all conversations, those of one conversation together and in order within a partition.

    ``loss_spans`` are code-point ranges of ``text``; the first ``n_repeated`` turns are context.
    """
    ranks = turns.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))  # one vocabulary file

    def run(batches):
        import tiktoken

        bpe = tiktoken.Encoding("turns", pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens={})
        open_id, state, out = None, None, []

        def record(rows):
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, _KINDS, strict=True)], names=_NAMES
            )

        for batch in batches:
            ids, roles, texts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for conv, role, text in zip(ids, roles, texts, strict=True):
                if state is None or conv != open_id:
                    if state is not None and (last := state.close()):
                        out.append((open_id, *last))
                    open_id, state = conv, Windows(budget, history)
                rendered = render(role, text)
                done = state.add(role, text, len(bpe.encode_ordinary(rendered[0])), rendered, role == loss_role)
                if done:
                    out.append((conv, *done))
            if out:
                yield record(out)
                out = []
        if state is not None and (last := state.close()):
            yield record([(open_id, *last)])

    rows = (
        turns.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            text_or_empty("role").alias("role"),
            text_or_empty("text").alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return bounded_batches(rows).mapInArrow(run, _SCHEMA)


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, from their text and mask alone (windows as ``format_windows`` gives them)."""

    def run(batches):
        open_id, began, done = None, False, []
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def start():
            return {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}

        def row(s):
            return (open_id, s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"])

        def record(rows):
            cols = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        s = start()
        for batch in batches:
            ids, texts, lead, spans = (batch.column(i).to_pylist() for i in (0, 2, 3, 6))
            for conv, text, skip, mask in zip(ids, texts, lead, spans, strict=True):
                if not began or conv != open_id:
                    if began:
                        done.append(row(s))
                    open_id, began, s = conv, True, start()
                for role, body, _, _ in parse(text)[skip:]:
                    s["n"] += 1
                    s["turns"].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                    s["chars"] += len(render(role, body)[0])
                for span in mask:
                    under = unescape(text[span["start"] : span["end"]])
                    s["loss"].update(under.encode("utf-8", "surrogatepass"))
                    s["loss_chars"] += len(under)
            if done:
                yield record(done)
                done = []
        if began:
            yield record([row(s)])

    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint"
    )
    return windows.mapInArrow(run, schema)


def control_conversation(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts look like marks of other templates."""
    said = "\\### Assistant: </turn> ok"
    return spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )


def formatting_report(conversations: DataFrame) -> DataFrame:
    cols = ["conv_id", "turn", "role", "text"]
    extra = control_conversation(conversations.sparkSession)
    return read_back(format_windows(conversations.select(*cols).unionByName(extra)))


ORACLE_SQL = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
    SELECT *,
           length(replace(replace(replace(role, '\', '\\'), '<', '\<'), '>', '\>')) AS role_chars,
           length(replace(replace(replace(text, '\', '\\'), '<', '\<'), '>', '\>')) AS text_chars
    FROM t
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(7 + role_chars + text_chars + 8) AS BIGINT) AS formatted_chars
FROM e
GROUP BY conv_id
"""

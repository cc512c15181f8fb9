"""Conversation structure repair: the cheapest edits that make the roles alternate.

A conversation is repaired when its role initials read ``(s?(ua)+)?``. Edits of a row: keep
(``K``, 0), give it the role user or assistant (``R``, 1), delete (``D``, 2, the only one for
a blank or duplicate row); an empty row may be inserted anywhere (``I``, 5); a truncated row
that stays adds 5. Among the cheapest sequences of edits the one whose letters come first in
ASCII is taken; it fixes every role, so the repair is unique.

The search is depth first with an explicit stack. A node is (rows read, state of the pattern,
whether the last edit was an insertion). The bound of a suffix is the exact cost of a wider
pattern in which a system row alone may be a conversation; one dive along the least bounds
sets the incumbent. Nodes are then visited in the order of their letters: a prefix that comes
later at a node comes later in ASCII too, so it must be strictly cheaper than what the node's
dominance table holds, and the first sequence of the least cost is the answer. Optimality is
proved when the stack is empty.

Rows are sorted by conversation in one shuffle and streamed; of a conversation the task holds
a byte or two and the digest of each row, its texts go through a spooled file, so memory does
not follow the length of the texts.

Defined cases: rows of one turn are ordered by role, then text; repeated rows are rows. A null
role or text is one space, a null id is a conversation of its own. A role whose initial is not
s, u or a (an empty one too) cannot be kept. An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import column
from paystrata.llm.registry import query

# Costs of the edits, and of a truncated row that stays.
RETYPE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
_MEMORY = 16 << 20
#: White space of the contract and the marks that end a sentence.
_SPACE = "\t\n\x0b\x0c\r "
_FAR = 1 << 60

# States of the pattern: nothing yet, after a leading system row, after a user row, after an
# assistant row. What may follow each, and where a conversation may end.
NONE, LED, ASKED, ANSWERED = range(4)
_NEXT = {NONE: {"s": LED, "u": ASKED}, LED: {"u": ASKED}, ASKED: {"a": ANSWERED}, ANSWERED: {"u": ASKED}}
_TURN = {NONE: "u", LED: "u", ASKED: "a", ANSWERED: "u"}
_ENDS = (NONE, ANSWERED)


def moves(state: int, initial: str, fault: str) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of a row's edits, in the order of their letters."""
    out = [("D", DELETE, state)]
    if fault not in "bd":
        more = UNFINISHED if fault == "t" else 0
        if initial in _NEXT[state]:
            out.append(("K", more, _NEXT[state][initial]))
        out.append(("R", RETYPE + more, _NEXT[state][_TURN[state]]))
    return out


def suffix_bounds(initials: str, faults: str) -> list[np.ndarray]:
    """Least cost from each row on, by state, if a system row alone might be a conversation."""
    n = len(initials)
    least = [np.full(n + 1, _FAR, dtype=np.int64) for _ in range(4)]
    after = [_FAR] * 4
    for i in range(n, -1, -1):
        if i == n:
            here = [0, 0, _FAR, 0]
        else:
            here = [min(cost + after[to] for _, cost, to in moves(q, initials[i], faults[i])) for q in range(4)]
        # An insertion first: one is enough, as two lead back or cost more than deleting.
        inserted = [INSERT + here[_NEXT[q][_TURN[q]]] for q in range(4)]
        after = [min(x, y) for x, y in zip(here, inserted)]
        for q in range(4):
            least[q][i] = after[q]
    return least


def _children(i: int, state: int, inserted: bool, initials: str, faults: str) -> list[tuple[str, int, int, int, bool]]:
    out = [(letter, cost, i + 1, to, False) for letter, cost, to in moves(state, initials[i], faults[i])] if i < len(initials) else []
    if not inserted:
        out.append(("I", INSERT, i, _NEXT[state][_TURN[state]], True))
        out.sort()
    return out


def cheapest(initials: str, faults: str) -> tuple[int, str]:
    """Cost and letters of the best edits of rows with these role initials and faults.

    ``faults`` has a letter a row: b(lank), d(uplicate), t(runcated) or a dot.
    """
    n, bound = len(initials), suffix_bounds(initials, faults)
    # The dive: the child of the least bound, until the rows and the pattern end.
    i, state, inserted, best_cost, letters = 0, NONE, False, 0, []
    while i < n or state not in _ENDS:
        further = _children(i, state, inserted, initials, faults)
        if not further:  # a system row alone: only the wider pattern ends here
            best_cost, letters = DELETE * n, ["D"] * n
            break
        letter, cost, i, state, inserted = min(further, key=lambda c: (c[1] + int(bound[c[3]][c[2]]), c[0]))
        best_cost += cost
        letters.append(letter)
    best = "".join(letters)

    # The proof: nodes in the order of their letters, the next one on top.
    seen = [np.full(n + 1, _FAR, dtype=np.int64) for _ in range(8)]
    stack: list[tuple[int, str, int, int, int, bool]] = [(0, "", 0, 0, NONE, False)]
    path: list[str] = []
    while stack:
        depth, letter, cost, i, state, inserted = stack.pop()
        del path[max(depth - 1, 0):]
        if letter:
            path.append(letter)
        table = seen[2 * state + inserted]
        if cost + int(bound[state][i]) > best_cost or cost >= table[i]:
            continue
        table[i] = cost
        if i == n and state in _ENDS:
            audit = "".join(path)
            if (cost, audit) < (best_cost, best):
                best_cost, best = cost, audit
        for step, more, to, after, ins in reversed(_children(i, state, inserted, initials, faults)):
            stack.append((depth + 1, step, cost + more, to, after, ins))
    return best_cost, best


def fault_of(role: str, text: str, seen: set[bytes]) -> str:
    body = text.rstrip(_SPACE)
    key = hashlib.blake2b(role.encode() + b"\xff" + text.encode(), digest_size=16).digest()
    known = key in seen
    seen.add(key)
    return "b" if not body else "d" if known else "." if body[-1] in ".!?" else "t"


class _Conversation:
    """One conversation as it comes in: flags of each row in memory, rows in a spooled file."""

    def __init__(self):
        self.initials, self.faults, self.seen, self.turns = [], [], set(), []
        self.file = tempfile.SpooledTemporaryFile(max_size=_MEMORY)

    def add(self, turn, role: str, text: str) -> None:
        self.initials.append(role[:1] or "\0")
        self.faults.append(fault_of(role, text, self.seen))
        self.turns.append(turn)
        for part in (role.encode(), text.encode()):
            self.file.write(len(part).to_bytes(8, "little") + part)

    def _part(self) -> str:
        return self.file.read(int.from_bytes(self.file.read(8), "little")).decode()

    def edits(self) -> Iterator[tuple]:
        """(seq, edit, turn, role, text, initial, fault), in order."""
        audit = cheapest("".join(self.initials), "".join(self.faults))[1]
        self.file.seek(0)
        at, state = 0, NONE
        for seq, letter in enumerate(audit):
            if letter == "I":
                yield seq, letter, None, ROLES[_TURN[state]], "", None, None
                state = _NEXT[state][_TURN[state]]
                continue
            role, text = self._part(), self._part()
            turn, initial, fault = self.turns[at], self.initials[at], self.faults[at]
            at += 1
            if letter == "R":
                role = ROLES[_TURN[state]]
            if letter != "D":
                state = _NEXT[state][role[0]]
            yield seq, letter, turn, role, text, initial, fault
        self.file.close()


_EDITS = "conv_id bigint, seq int, edit string, turn bigint, role string, text string, initial string, fault string"
#: Rows and bytes of text of an output batch.
_ROWS, _BYTES = 4096, 4 << 20


class _Out:
    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= _ROWS or self.size >= _BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.size = [], 0


def repair(rows: DataFrame) -> DataFrame:
    """The edits of every conversation: (conv_id, seq, edit, turn, role, text, initial, fault).

    ``rows`` has conv_id, turn, role, text and ``gone``: rows that are only there to name their
    conversation, which has edits of the others alone, or one row without an edit if there are
    none. Role and text are those after the edit; of a deleted row, its own. Edits of a
    conversation follow one another in order within one partition.
    """
    dealt = (rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"), "gone")
             .repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text"))
    schema = pa.schema([("conv_id", pa.int64()), ("seq", pa.int32()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()),
                        ("text", pa.string()), ("initial", pa.string()), ("fault", pa.string())])

    def edited(batches):
        out, open_id, conv = _Out(schema), None, None

        def close():
            n = 0
            for n, row in enumerate(conv.edits(), 1):
                yield from out.add((open_id, *row), len(row[4]))
            if not n:
                yield from out.add((open_id, -1, None, None, None, None, None, None))

        for batch in batches:
            ids, turns, gone = (column(batch, c).to_pylist() for c in ("conv_id", "turn", "gone"))
            roles, texts = column(batch, "role"), column(batch, "text")
            for i in range(batch.num_rows):
                if conv is None or ids[i] != open_id:
                    if conv is not None:
                        yield from close()
                    open_id, conv = ids[i], _Conversation()
                if not gone[i]:
                    conv.add(turns[i], roles[i].as_py(), texts[i].as_py())
        if conv is not None:
            yield from close()
        yield from out.flush()

    return dealt.mapInArrow(edited, _EDITS)


_REPORT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")
_COST = {"K": 0, "R": RETYPE, "D": DELETE, "I": INSERT}


def report(edits: DataFrame) -> DataFrame:
    """One row a conversation: counts over the rows before the edits, cost, letters, digest of the repair."""
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    schema = pa.schema(list(zip([c.split()[0] for c in _REPORT.split(", ")], kinds)))

    class Tally:
        def __init__(self):
            self.turns, self.faults, self.illegal, self.cost, self.audit = set(), dict.fromkeys("bdt", 0), 0, 0, []
            self.before, self.digest, self.first = None, hashlib.sha256(), True

        def add(self, edit, turn, role, text, initial, fault):
            self.audit.append(edit)
            self.cost += _COST[edit] + (UNFINISHED if fault == "t" and edit != "D" else 0)
            if edit != "I":
                self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
                self.before = initial
                if fault in self.faults:
                    self.faults[fault] += 1
                if turn is not None:
                    self.turns.add(turn)
            if edit != "D":
                self.digest.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
                self.first = False

        def row(self, conv_id):
            gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
            return (conv_id, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())

    def tallied(batches):
        out, open_id, tally = _Out(schema), None, None
        for batch in batches:
            ids, *rest = (column(batch, c) for c in ("conv_id", "edit", "turn", "role", "text", "initial", "fault"))
            ids = ids.to_pylist()
            for i in range(batch.num_rows):
                if tally is None or ids[i] != open_id:
                    if tally is not None:
                        yield from out.add(tally.row(open_id))
                    open_id, tally = ids[i], Tally()
                row = [c[i].as_py() for c in rest]
                if row[0] is not None:
                    tally.add(*row)
        if tally is not None:
            yield from out.add(tally.row(open_id))
        yield from out.flush()

    return edits.mapInArrow(tallied, _REPORT)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with known faults, by the checksum of ``conv_id:turn``; see the contract of the query."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    case = F.col("case")
    return (rows.withColumn("case", F.crc32(key.cast("binary")) % 20)
            .select("conv_id", "turn", F.when(case == 4, "user").otherwise(role).alias("role"),
                    F.when(case == 1, "").when(case == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                    (case == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(case == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


@query("op11_conversation_repair", r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::UBIGINT)),
      lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 20 AS k
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM keyed WHERE k <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '.' END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair FROM placed),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faulty GROUP BY conv_id),
-- q: 0 nothing yet, 1 after a leading system row, 2 after a user row, 3 after an assistant row
search AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {'cost': 0, 'audit': '', 'rows': ''} AS best FROM counted
  UNION ALL
  SELECT conv_id, i, q, min(best) AS best FROM (
    SELECT p.conv_id, f.i, e.q, {'cost': p.best.cost + e.cost, 'audit': p.best.audit || e.edit, 'rows': p.best.rows || e.line} AS best
    FROM (SELECT conv_id, i, q, best FROM search
          UNION ALL SELECT conv_id, i, CASE q WHEN 2 THEN 3 ELSE 2 END, {'cost': best.cost + 5, 'audit': best.audit || 'I',
            'rows': best.rows || chr(10) || CASE q WHEN 2 THEN 'assistant:' ELSE 'user:' END} FROM search) p
    JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1,
    LATERAL (SELECT 'D' AS edit, 2 AS cost, p.q AS q, '' AS line
      UNION ALL SELECT 'K', CASE fault WHEN 't' THEN 5 ELSE 0 END, CASE WHEN left(f.role, 1) = 's' THEN 1 WHEN p.q = 2 THEN 3 ELSE 2 END,
        chr(10) || f.role || ':' || f.text WHERE f.fault NOT IN ('b', 'd')
        AND (left(f.role, 1) = CASE p.q WHEN 2 THEN 'a' ELSE 'u' END OR p.q = 0 AND left(f.role, 1) = 's')
      UNION ALL SELECT 'R', CASE fault WHEN 't' THEN 6 ELSE 1 END, CASE p.q WHEN 2 THEN 3 ELSE 2 END,
        chr(10) || CASE p.q WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text WHERE f.fault NOT IN ('b', 'd')) e)
  GROUP BY conv_id, i, q),
ended AS (
  SELECT c.conv_id, min(CASE WHEN q = 2 THEN {'cost': best.cost + 5, 'audit': best.audit || 'I', 'rows': best.rows || chr(10) || 'assistant:'}
    ELSE best END) AS best FROM search s JOIN counted c ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.n WHERE q <> 1 GROUP BY c.conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(substr(best.rows, 2), '')) AS repaired_sha256
FROM ids LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id""")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by the contract's rule, and its cheapest repair."""
    return report(repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))

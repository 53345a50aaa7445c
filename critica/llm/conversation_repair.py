"""Operator 13: conversation structure repair over a suffix-shared automaton of role/fault signatures.

Every row becomes one symbol: its role (s, u, a or other, by first character) and whether it must go (blank, or a copy of
an earlier row), ends truncated, or is sound. A conversation's symbols in order are its signature; most conversations
share theirs with others, and far more share the end of it.

The distinct signatures form a word graph that is minimised from the end: a node is one suffix, whatever conversations
and positions it ends. Signatures are range-partitioned and sorted by their reversal, so equal suffixes lie next to each
other, and a task holds only the chain of nodes of the signature at hand: the nodes it shares with the one before are
kept, the rest is built. At each node, for each state of the role grammar ``(s?(ua)+)?``, the least cost to reach the
end and the first edit of the best audit are computed once; the first edits of a chain spell every best audit suffix.
Going backwards makes ties easy: audits from one node and state differ in their first letter, or share it and go on from
the same node and state, so the ASCII-least cheapest audit takes the least letter among the cheapest edits.
Only suffixes that straddle the border of two ranges are computed in both.

Costs: keep 0, rerole to user or assistant 1, delete 2 (required for blank rows and copies), insert an empty turn 5;
a truncated row that stays adds 5.

Scale: signatures need neither texts nor conversations in memory: rows are shuffled without their text (a digest tells
copies) and stream through sorted. Signatures are grouped before they are compared, and joined back by an equi-join
that adaptive execution can split. Repaired rows come from a second sorted stream, in which each conversation's audit
goes before its rows. A conversation of any length takes memory for its symbols and row digests, not for its texts; it
is read by one task, since its audit and its hash are one sequence.

Defined results: a null text or role is one space, so a null text is blank; null turns come first; rows of equal turn are
ordered by role, then by the SHA-256 of the text; repeated rows are rows of their own, so all but the first are copies;
rows with a null conv_id are one conversation; a conversation without rows (see ``present``) has zero counts, an empty
audit and the empty string's hash; an empty role has the initial "" and stands for none of s, u, a; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from critica.llm.common import WS_CLASS, read, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# Grammar states: 0 nothing yet, 1 after the system turn, 2 after a user turn, 3 after an assistant turn (0 and 3 accept)
EMITS = (1, 1, 2, 1)  # role that an insertion or rerole gives in each state: 1 user, 2 assistant
AFTER = (2, 2, 3, 2)  # state after it
KEEPS = ((1, 2, None), (None, 2, None), (None, None, 3), (None, 2, None))  # state after keeping s, u, a
ROLES = ("system", "user", "assistant")

# Signature symbols: g = must go; role s, u, a, o (other), upper case if truncated
GONE = "g"

STEPWISE = 300  # symbols of a shared suffix that are compared one by one


def costs_of(symbol: str, below):
    """(costs, edits) per grammar state of a node whose first row is ``symbol`` and whose remaining suffix costs ``below``."""
    costs, edits = [0] * 4, [""] * 4
    late = 0 if symbol == GONE or symbol.islower() else TRUNCATED
    role = "sua".find(symbol.lower())
    for s in range(4):
        found = [(DELETE + below[s], "D")]
        if symbol != GONE:
            if role >= 0 and KEEPS[s][role] is not None:
                found.append((KEEP + late + below[KEEPS[s][role]], "K"))
            found.append((REROLE + late + below[AFTER[s]], "R"))
        costs[s], edits[s] = min(found)
    plain = list(costs)
    for _ in range(2):  # an insertion leads to another state of the same node; two in a row reach every state
        for s in range(4):
            costs[s] = min(costs[s], INSERT + costs[AFTER[s]])
    for s in range(4):
        inserted = INSERT + costs[AFTER[s]] == costs[s]
        if inserted and (plain[s] > costs[s] or edits[s] > "I"):
            edits[s] = "I"
    return costs, edits


END = ((0, 10, 5, 0), ("", "I", "I", ""))  # the empty suffix


class SuffixChain:
    """Nodes of one signature from its end to its start; the next signature keeps those of the suffix it shares."""

    def __init__(self):
        self.signature = ""  # reversed
        self.costs, self.edits = [END[0]], [END[1]]
        self.built = 0
        self.known: dict[tuple, tuple] = {}  # (symbol, costs below relative to the least) -> the same node's values

    def load(self, signature: str) -> None:
        back = signature[::-1]
        keep = common_prefix(self.signature, back)
        del self.costs[keep + 1:], self.edits[keep + 1:]
        for symbol in back[keep:]:
            below = self.costs[-1]
            low = min(below)
            key = (symbol, *(c - low for c in below))
            node = self.known.get(key)
            if node is None:  # cost differences are bounded by the cost of two insertions, so these are few
                node = self.known[key] = costs_of(symbol, key[1:])
            self.costs.append(tuple(c + low for c in node[0]))
            self.edits.append(node[1])
            self.built += 1
        self.signature = back

    def best(self) -> tuple[int, str]:
        """Cost and audit of the loaded signature from the start of the grammar."""
        at, state, audit = len(self.edits) - 1, 0, []
        while edit := self.edits[at][state]:
            audit.append(edit)
            if edit == "I":
                state = AFTER[state]
                continue
            symbol = self.signature[at - 1].lower()
            at -= 1
            if edit == "R":
                state = AFTER[state]
            elif edit == "K":
                state = KEEPS[state]["sua".index(symbol)]
        return self.costs[-1][0], "".join(audit)


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for k in range(min(n, STEPWISE)):
        if a[k] != b[k]:
            return k
    if a[:n] == b[:n]:
        return n
    low, high = min(n, STEPWISE), n
    while high - low > 1:  # a[:low] == b[:low], a[:high] != b[:high]
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def audits(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of distinct ``signatures``."""
    def run(batches):
        import pyarrow as pa

        chain = SuffixChain()
        for batch in batches:
            rows = batch.column(0).to_pylist()
            costs, found = [], []
            for signature in rows:
                chain.load(signature)
                cost, audit = chain.best()
                costs.append(cost)
                found.append(audit)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(costs, pa.int64()),
                                              pa.array(found, pa.string())], ["signature", "cost", "audit"])

    back = F.reverse("signature")
    return (signatures.select("signature").repartitionByRange(back).sortWithinPartitions(back)
            .mapInArrow(run, "signature string, cost bigint, audit string"))


# --- rows ----------------------------------------------------------------------------------------------------------

def conversation_rows(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text", copies: Column | None = None, new_role: Column | None = None,
                      new_text: Column | None = None) -> DataFrame:
    """Rows to repair: (conv_id, turn, order, present, role, text).

    ``copies`` says how often each row of ``df`` stands there (0: only its conversation stays known). ``new_role`` and
    ``new_text`` replace values after the order of rows with equal turns is fixed by the old ones.
    """
    old_role = F.coalesce(F.col(role).cast("string"), F.lit(" "))
    old_text = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    n = (F.lit(1) if copies is None else copies).cast("int")
    rows = df.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                     F.struct(old_role.alias("role"), F.sha2(old_text, 256).alias("digest")).alias("order"),
                     (n > 0).alias("present"), (old_role if new_role is None else new_role).alias("role"),
                     (old_text if new_text is None else new_text).alias("text"),
                     F.explode(F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Each conversation's rows together and in order, for one pass over the partition."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *first, F.asc_nulls_first("turn"), "order.role", "order.digest")


REPORT = ("conv_id bigint, signature string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
          "illegal bigint")


def signatures(rows: DataFrame) -> DataFrame:
    """(conv_id, signature, gaps, blank, duplicate, truncated, illegal) of every conversation of ``rows``.

    The first fault of a row counts: blank, copy of an earlier row (role and text), truncated.
    """
    text = F.col("text")
    tail = F.rtrim(F.regexp_replace(F.right(text, F.lit(1)), WS_CLASS, " "))
    # the last character that is no white space: usually the last one, so the whole text is searched only where it is not
    last = F.when(tail != "", tail).otherwise(F.right(F.btrim(text, F.lit(" \t\n\u000b\f\r")), F.lit(1)))
    narrow = rows.select("conv_id", "turn", "order", "present", F.substring("role", 1, 1).alias("initial"),
                         F.sha2(F.concat(F.lpad(F.char_length("role").cast("string"), 12, " "), "role", "text"), 256).alias("same"),
                         last.alias("last"))

    def run(batches):
        import pyarrow as pa

        names = ["conv_id", "signature", "gaps", "blank", "duplicate", "truncated", "illegal"]
        at, known, out = None, None, []

        def close():
            turns, distinct, low, high, seen, symbols, illegal, _, found = known
            out.append((at, "".join(symbols), (high - low + 1 - distinct) if distinct else 0, *found, illegal))

        def batch_of(rows):
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == 1 else pa.int64())
                                               for k, c in enumerate(columns)], names)

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (0, 1, 3, 4, 5, 6)]
            for conv, turn, present, initial, same, last in zip(*columns):
                if known is None or conv != at:
                    if known is not None:
                        close()
                    at, known = conv, [None, 0, 0, 0, set(), [], 0, None, [0, 0, 0]]
                if not present:
                    continue
                if turn is not None and (not known[1] or turn != known[0]):
                    known[2] = turn if not known[1] else known[2]
                    known[0], known[3] = turn, turn
                    known[1] += 1
                if known[7] is not None and known[7] + initial not in ("su", "ua", "au"):
                    known[6] += 1
                known[7] = initial
                key = bytes.fromhex(same)
                letter = initial if initial in ("s", "u", "a") else "o"
                if not last:
                    known[8][0] += 1
                    letter = GONE
                elif key in known[4]:
                    known[8][1] += 1
                    letter = GONE
                elif last not in ".!?":
                    known[8][2] += 1
                    letter = letter.upper()
                known[4].add(key)
                known[5].append(letter)
            yield batch_of(out)
            out = []
        if known is not None:
            close()
            yield batch_of(out)

    return _in_order(narrow).mapInArrow(run, REPORT)


def reports(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``rows``."""
    found = stored(signatures(rows), "signatures")
    best = stored(audits(found.select("signature").distinct()), "audits")
    return (found.join(best, "signature")
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))


MESSAGES = "conv_id bigint, position bigint, edit string, role string, text string, repaired_sha256 string"


def apply_audits(rows: DataFrame, report: DataFrame, messages: bool = True) -> DataFrame:
    """Repaired rows (conv_id, position, edit, role, text) in order, and one closing row per conversation.

    The closing row has edit and role null, as position the number of repaired rows, and the SHA-256 of all
    ``role:text``, joined by newlines. ``messages=False`` returns the closing rows only.
    """
    before = report.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"),
                           F.lit(None).cast("struct<role:string,digest:string>").alias("order"),
                           F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    both = before.unionByName(rows.where("present").select("conv_id", F.lit(1).alias("kind"), "turn", "order", "role", "text"))

    def run(batches):
        import hashlib

        import pyarrow as pa

        names = [f.split()[0] for f in MESSAGES.split(", ")]
        out: list = []
        held = 0
        at, audit, place, state, position, digest, opened = None, "", 0, 0, 0, None, False

        def take(conv, edit, role, text):
            nonlocal position, held
            digest.update(("\n" if position else "").encode() + role.encode() + b":")
            digest.update(text.encode())
            if messages:
                out.append((conv, position, edit, role, text, None))
                held += len(text) + 64
            position += 1

        def inserts():
            nonlocal place, state
            while place < len(audit) and audit[place] == "I":
                take(at, "I", ROLES[EMITS[state]], "")
                state = AFTER[state]
                place += 1

        def close():
            inserts()
            out.append((at, position, None, None, None, digest.hexdigest()))

        def flush():
            nonlocal out, held
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
            out, held = [], 0
            return made

        for batch in batches:
            for a in range(0, len(batch), 512):
                part = batch.slice(a, 512)
                for conv, kind, role, text in zip(*(part.column(k).to_pylist() for k in (0, 1, 4, 5))):
                    if kind == 0:
                        if opened:
                            close()
                        at, audit, place, state, position = conv, text, 0, 0, 0
                        digest, opened = hashlib.sha256(), True
                        continue
                    inserts()
                    edit = audit[place]
                    place += 1
                    if edit == "R":
                        take(conv, edit, ROLES[EMITS[state]], text)
                        state = AFTER[state]
                    elif edit == "K":
                        take(conv, edit, role, text)
                        state = KEEPS[state]["sua".index(role[0])]
                    if held > 4 << 20:
                        yield flush()
            yield flush()
        if opened:
            close()
            yield flush()

    return _in_order(both, "kind").mapInArrow(run, MESSAGES)


def repair_conversations(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """The repaired rows (conv_id, position, edit, role, text) of the conversations in ``df``."""
    rows = conversation_rows(df, conv_id, turn, role, text)
    made = apply_audits(rows, stored(reports(rows), "reports"))
    return made.where(F.col("edit").isNotNull()).drop("repaired_sha256")


def damaged(df: DataFrame) -> DataFrame:
    """``conversation_rows`` of a table after the damage by crc32(conv_id:turn) % 20."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    code = F.crc32(key) % 20
    text = F.coalesce(F.col("text"), blank)
    return conversation_rows(df, copies=F.when(code == 0, 0).when(code == 3, 2).otherwise(1),
                             new_role=F.when(code == 4, "user").otherwise(F.coalesce(F.col("role"), blank)),
                             new_text=F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    report = stored(reports(rows), "reports")
    closing = apply_audits(rows, report, messages=False).select("conv_id", "repaired_sha256")
    one = F.coalesce(F.col("conv_id"), F.lit(0)), F.col("conv_id").isNull()
    left, right = report.withColumns({"k": one[0], "z": one[1]}), closing.withColumns({"k": one[0], "z": one[1]}).drop("conv_id")
    return left.join(right, ["k", "z"]).drop("k", "z")


# DuckDB twin: CRC-32 bit by bit, faults by windows, the same programme backwards over (cost, audit) pairs, and the repaired
# roles from the audit: after an optional kept system turn, repaired turns alternate user, assistant.
_OPTIONS = """least(
      {{'c': t.f{s}.c + 2, 'a': 'D' || t.f{s}.a}},
      case when sym <> 'g' then {{'c': t.f{n}.c + 1 + late, 'a': 'R' || t.f{n}.a}} else {{'c': 1000000000, 'a': ''}} end,
      case when {keep} then {{'c': t.f{k}.c + late, 'a': 'K' || t.f{k}.a}} else {{'c': 1000000000, 'a': ''}} end)"""


def _sql() -> str:
    keep = {0: "sym in ('s', 'u')", 1: "sym = 'u'", 2: "sym = 'a'", 3: "sym = 'u'"}
    plain = []
    for s in range(4):
        option = _OPTIONS.format(s=s, n=AFTER[s], keep=keep[s], k={0: "KK", 1: 2, 2: 3, 3: 2}[s])
        if s == 0:  # keeping s leads to state 1, keeping u to state 2
            option = option.replace("t.fKK.c", "(case when sym = 's' then t.f1.c else t.f2.c end)").replace(
                "t.fKK.a", "(case when sym = 's' then t.f1.a else t.f2.a end)")
        plain.append(f"{option} as p{s}")
    ins = "least({p}, {{'c': 5 + {q}.c, 'a': 'I' || {q}.a}})"
    once = ", ".join(f"{ins.format(p=f'p{s}', q=f'p{AFTER[s]}')} as q{s}" for s in range(4))
    twice = ", ".join(f"{ins.format(p=f'p{s}', q=f'q{AFTER[s]}')} as f{s}" for s in range(4))
    white = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with recursive src as materialized (
  select row_number() over () as rid, conv_id, turn, coalesce(role, ' ') as role0, coalesce(text, ' ') as text0,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations),
coded as materialized (
  select *, xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
      list_transform(range(1, length(key) + 1), lambda i: ascii(key[i])::bigint)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 20 as code
  from src),
rows as materialized (
  select conv_id, turn, role0, text0, rid, copy, case when code = 4 then 'user' else role0 end as role,
    case when code = 1 then '' when code = 2 then regexp_replace(text0, '[.!?]', '', 'g') else text0 end as text
  from coded, (values (1), (2)) n(copy) where code <> 0 and copy <= case when code = 3 then 2 else 1 end),
placed as materialized (
  select *, row_number() over (partition by conv_id order by turn nulls first, role0, sha256(text0), rid, copy) as k,
    right(trim(text, {white}), 1) as tail from rows),
faulty as materialized (
  select *, left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by k) as prev,
    case when tail = '' then 'b' when row_number() over (partition by conv_id, role, text order by k) > 1 then 'd'
         when tail not in ('.', '!', '?') then 't' else '' end as fault
  from placed),
chain as materialized (
  select conv_id, k, role, text, count(*) over (partition by conv_id) - k as back,
    case when fault in ('b', 'd') then 'g' when initial in ('s', 'u', 'a') then initial else 'o' end as sym,
    case when fault = 't' then 5 else 0 end as late from faulty),
best as (
  select conv_id, -1::bigint as back, {{'c': 0, 'a': ''}} as f0, {{'c': 10, 'a': 'II'}} as f1,
    {{'c': 5, 'a': 'I'}} as f2, {{'c': 0, 'a': ''}} as f3 from (select distinct conv_id from chain)
  union all
  select conv_id, back, {twice} from (
    select conv_id, back, p0, p1, p2, p3, {once} from (
      select t.conv_id, r.back, {', '.join(plain)}
      from best t join chain r on r.conv_id is not distinct from t.conv_id and r.back = t.back + 1))),
audits as materialized (
  select conv_id, max_by(f0, back) as f from best group by conv_id),
edits as (
  select conv_id, f.a[i::int] as e, i from audits, unnest(range(1, length(f.a) + 1)) u(i)),
matched as (
  select conv_id, e, i, case when e <> 'I' then count(*) filter (e <> 'I') over (partition by conv_id order by i) end as k from edits),
kept as (
  select m.conv_id, m.e, m.i, r.role, r.text,
    row_number() over (partition by m.conv_id order by m.i) as pos,
    first_value(m.e = 'K' and left(r.role, 1) = 's') over (partition by m.conv_id order by m.i) as sys
  from matched m left join chain r on r.conv_id is not distinct from m.conv_id and r.k = m.k where m.e <> 'D'),
texts as (
  select conv_id, sha256(string_agg((case when e = 'K' then role when (pos + sys::int) % 2 = 1 then 'user' else 'assistant' end)
      || ':' || coalesce(text, ''), chr(10) order by i)) as h
  from kept group by conv_id),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
    count(*) filter (fault = 't') as truncated,
    count(*) filter (prev is not null and prev || initial not in ('su', 'ua', 'au')) as illegal
  from faulty group by conv_id)
select i.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(c.blank, 0) as blank, coalesce(c.duplicate, 0) as duplicate,
  coalesce(c.truncated, 0) as truncated, coalesce(c.illegal, 0) as illegal, coalesce(b.f.c, 0)::bigint as cost,
  coalesce(b.f.a, '') as audit, coalesce(t.h, sha256('')) as repaired_sha256
from (select distinct conv_id from src) i
left join counts c on c.conv_id is not distinct from i.conv_id
left join audits b on b.conv_id is not distinct from i.conv_id
left join texts t on t.conv_id is not distinct from i.conv_id
"""


OP13_SQL = _sql()

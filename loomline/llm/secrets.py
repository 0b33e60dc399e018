"""Secret scans by one combined deterministic automaton.

Rules are regular expressions over bytes (classes, groups, alternation, *, +, ?, {m}, {m,}, {m,n}). They are
parsed to an automaton with all rules side by side, turned into a deterministic one by subset construction,
and minimised by partition refinement; states carry the set of rules that accept there. The transition
arrays take one step for each byte of a text and so scan all rules in one pass. It reports, for each rule,
the end of each run of accepting states; the start is found by the automaton of the reversed rule, read
backwards from the end, as the leftmost start that doesn't reach into the match before. Spans are turned
from bytes to code points.

Defined results: a null text is empty and has no spans; rows that share an id each return a row; spans are
counted in code points, end exclusive; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import rows_to_batches

ANY = frozenset(range(256))
DIGIT, LOWER, UPPER = frozenset(b"0123456789"), frozenset(range(97, 123)), frozenset(range(65, 91))
WORD = DIGIT | LOWER | UPPER | {95}


class Rule(NamedTuple):
    kind: str
    pattern: str
    ignore_case: bool = False
    #: The least length in bytes of what follows the pattern's head (see head); shorter matches are dropped but still consume text.
    least: int = 0
    #: A pattern for what stands before the measured part; "" measures the whole match.
    head: str = ""


#: The three base kinds, in the order in which spans that start together are listed, and the kinds that the scan adds.
ASSIGN_HEAD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE_RULES = (
    Rule("assign", ASSIGN_HEAD + r"[A-Za-z0-9+/_.=-]+", ignore_case=True, least=12, head=ASSIGN_HEAD),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]+", least=40),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]+", least=27),
)


class _Parser:
    """Pattern text to a tree: ("set", frozenset), ("cat", [..]), ("alt", [..]), ("rep", node, low, high)."""

    def __init__(self, pattern: str, ignore_case: bool):
        self.text, self.at, self.fold = pattern, 0, ignore_case

    def parse(self):
        node = self.alternatives()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at :]!r}")
        return node

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("alt", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            node = self.atom()
            while self.peek() in ("*", "+", "?", "{"):
                low, high = self.counts()
                node = ("rep", node, low, high)
            parts.append(node)
        return ("cat", parts)

    def counts(self):
        c = self.next()
        if c != "{":
            return {"*": (0, None), "+": (1, None), "?": (0, 1)}[c]
        body = self.text[self.at : (end := self.text.index("}", self.at))]
        self.at = end + 1
        low, comma, high = body.partition(",")
        return int(low), int(high) if high else None if comma else int(low)

    def atom(self):
        c = self.next()
        if c == "(":
            node = self.alternatives()
            if self.next() != ")":
                raise ValueError("missing )")
            return node
        if c == "[":
            return ("set", self.folded(self.bracket()))
        if c == ".":
            return ("set", ANY - {10})
        return ("set", self.folded(self.escaped() if c == "\\" else self.literal(c)))

    def bracket(self):
        negated = self.peek() == "^"
        self.at += negated
        found: set[int] = set()
        while (c := self.next()) != "]":
            low = self.escaped() if c == "\\" else self.literal(c)
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                c = self.next()
                high = self.escaped() if c == "\\" else self.literal(c)
                found.update(range(min(low), max(high) + 1))
            else:
                found |= low
        return ANY - found if negated else frozenset(found)

    def escaped(self):
        c = self.next()
        if c == "x":
            self.at += 2
            return frozenset({int(self.text[self.at - 2 : self.at], 16)})
        return {"d": DIGIT, "w": WORD, "s": frozenset(b" \t\n\r\f\v"), "n": frozenset(b"\n"), "t": frozenset(b"\t")}.get(c) or self.literal(c)

    @staticmethod
    def literal(c):
        data = c.encode()
        if len(data) != 1:
            raise ValueError(f"not an ASCII character: {c!r}")
        return frozenset(data)

    def folded(self, found):
        return frozenset(found | {b ^ 32 for b in found if b in LOWER or b in UPPER}) if self.fold else frozenset(found)

    def peek(self):
        return self.text[self.at : self.at + 1]

    def next(self):
        if self.at >= len(self.text):
            raise ValueError("pattern ends early")
        self.at += 1
        return self.text[self.at - 1]


def _reverse(node):
    kind = node[0]
    if kind == "cat":
        return ("cat", [_reverse(n) for n in reversed(node[1])])
    if kind == "alt":
        return ("alt", [_reverse(n) for n in node[1]])
    return ("rep", _reverse(node[1]), *node[2:]) if kind == "rep" else node


class _Nfa:
    """States with empty moves and moves on byte sets."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, node, start: int) -> int:
        """Add a tree after start; returns its end state."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "cat":
            for n in node[1]:
                start = self.add(n, start)
            return start
        if kind == "alt":
            end = self.state()
            for n in node[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.add(n, first)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.add(inner, start)
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.add(inner, loop)].append(loop)
            return loop
        end = self.state()
        self.empty[start].append(end)
        for _ in range(high - low):
            start = self.add(inner, start)
            self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for n in self.empty[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return frozenset(seen)


@dataclass
class Dfa:
    """Transition arrays: table[state][byte] is the next state; accepts[state] has the rules that accept there; state 0 starts."""

    table: list[list[int]]
    accepts: list[frozenset[int]]

    def linked(self) -> list:
        """The arrays as lists of lists: entry b of a state's list is the next state's list, entry 256 its rules, if any."""
        rows: list[list] = [[] for _ in self.table]
        for row, nexts, rules in zip(rows, self.table, self.accepts, strict=True):
            row.extend(rows[n] for n in nexts)
            row.append(rules or None)
        return rows


def compile_rules(trees: list, searching: bool) -> Dfa:
    """Subset construction over all trees, then minimisation. searching: a match may start at any byte."""
    nfa = _Nfa()
    root = nfa.state()
    ends: dict[int, int] = {}
    for k, tree in enumerate(trees):
        first = nfa.state()
        nfa.empty[root].append(first)
        ends[nfa.add(tree, first)] = k
    begin = nfa.closure([root])
    numbers, todo, table, accepts = {begin: 0}, [begin], [], []
    for states in todo:  # grows while it is read
        reach: dict[int, set[int]] = {}
        for s in states:
            for found, n in nfa.moves[s]:
                for b in found:
                    reach.setdefault(b, set()).add(n)
        row = []
        cache: dict[frozenset[int], frozenset[int]] = {}
        for b in range(256):
            to = frozenset(reach.get(b, ()))
            if to not in cache:
                cache[to] = nfa.closure([*to, root] if searching else to)
            target = cache[to]
            if target not in numbers:
                numbers[target] = len(numbers)
                todo.append(target)
            row.append(numbers[target])
        table.append(row)
        accepts.append(frozenset(ends[s] for s in states if s in ends))
    return _minimised(Dfa(table, accepts))


def _minimised(dfa: Dfa) -> Dfa:
    """Refine the partition by accepted rules until all states of a class go to the same classes."""
    names = {a: i for i, a in enumerate(dict.fromkeys(dfa.accepts))}
    group = [names[a] for a in dfa.accepts]
    while True:
        seen: dict[tuple, int] = {}
        refined = [seen.setdefault((group[s], *[group[n] for n in row]), len(seen)) for s, row in enumerate(dfa.table)]
        if len(seen) == len(set(group)):
            break
        group = refined
    first = list(dict.fromkeys(refined))
    place = {g: i for i, g in enumerate(first)}
    table, accepts = [[]] * len(first), [frozenset()] * len(first)
    for s, g in enumerate(refined):
        table[place[g]], accepts[place[g]] = [place[refined[n]] for n in dfa.table[s]], dfa.accepts[s]
    return Dfa(table, accepts)


class Scanner:
    """All rules in one automaton."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        trees = [_Parser(r.pattern, r.ignore_case).parse() for r in rules]
        self.forward = compile_rules(trees, searching=True).linked()
        self.back = [compile_rules([_reverse(t)], searching=False).linked() for t in trees]
        self.dead = [next(i for i, row in enumerate(b) if row[256] is None and all(n is row for n in row[:256])) for b in self.back]
        self.heads = [compile_rules([_Parser(r.head, r.ignore_case).parse()], searching=False).linked() if r.head else None for r in rules]

    def runs(self, data: bytes) -> list[tuple[int, int]]:
        """(rule, end) of each run of accepting states, in order of ends; one step a byte."""
        row = self.forward[0]
        found: list[tuple[int, int]] = []
        active: frozenset[int] | None = None
        for at, byte in enumerate(data):
            row = row[byte]
            now = row[256]
            if now is not active:
                if active:
                    found += [(rule, at) for rule in active if not now or rule not in now]
                active = now
        return found + [(rule, len(data)) for rule in active or ()]

    def start(self, rule: int, data: bytes, end: int, floor: int) -> int | None:
        """The leftmost start, not before floor, of a match of the rule that ends at end."""
        rows = self.back[rule]
        row, dead, best = rows[0], rows[self.dead[rule]], None
        for at in range(end - 1, floor - 1, -1):
            row = row[data[at]]
            if row is dead:
                break
            if row[256]:
                best = at
        return best

    def measured(self, rule: int, data: bytes, start: int, end: int) -> int:
        """Length of the part of a match that the rule's least length is about."""
        rows = self.heads[rule]
        if not rows:
            return end - start
        row, cut = rows[0], start
        for at in range(start, end - 1):
            row = row[data[at]]
            if row[256]:
                cut = at + 1
        return end - cut

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, ordered by start, then by the order of rules."""
        data = text.encode()
        floors, spans = [0] * len(self.rules), []
        for rule, end in self.runs(data):
            start = self.start(rule, data, end, floors[rule])
            if start is None:
                continue
            floors[rule] = end
            if self.measured(rule, data, start, end) >= self.rules[rule].least:
                spans.append((start, rule, end))
        spans.sort()
        if len(data) == len(text):
            return [(self.rules[r].kind, a, b) for a, r, b in spans]
        out, at, chars = [], 0, 0
        for a, r, b in spans:
            chars += len(data[at:a].decode())
            at = a
            out.append((self.rules[r].kind, chars, chars + len(data[a:b].decode())))
        return out


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> Scanner:
    """One scanner a Python worker, whatever number of tasks it runs."""
    return Scanner(rules)


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and spans, an array of (kind, start, end) of all rules over the whole text."""
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("spans", T.ArrayType(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = compiled(rules)

        def rows():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    yield doc, [{"kind": k, "start": a, "end": b} for k, a, b in scanner.scan(text.as_py() or "")]

        yield from rows_to_batches(rows(), schema)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)

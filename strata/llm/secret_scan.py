"""Secret scans: all rules in one pass over the bytes of a text, by one combined automaton.

``automaton.compile_rules`` turns the rules into one minimal transition array on the driver; its size depends
on the rules alone. Tasks get it and read each text once, byte by byte; only where a rule has a match
do they look back from its end for its start. Offsets are code points, the end exclusive.

Matches of one kind are leftmost and do not overlap; matches of different kinds may.

Defined cases: a null or empty text has no spans. A text of any length is one pass with a state of
fixed size, plus its spans. Each row is judged by itself, so null ids, repeated rows and other
columns, whatever their names, play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.llm import text as X
from strata.llm.automaton import Rule, compile_rules, finder

# The rules every scan has.
_NAMES = "(?i:password|passwd|secret|token|api_?key)"
_JOIN = r"""["']?\x20*[:=]\x20*["']?"""
BASE = (
    Rule("assign", _NAMES + _JOIN + "[A-Za-z0-9+/_.=-]+", _NAMES + _JOIN + "[A-Za-z0-9+/_.=-]{6,}"),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]{6,}", least=24),  # the same runs as +, but short ones end no match
)
# What the scan adds: credentials with a form of their own.
MORE = (
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=48),
    Rule("code_host", "gh[opsur]_[A-Za-z0-9]+", least=40),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("payment", "[rs]k_(live|test)_[A-Za-z0-9]+", least=24),
    Rule("cloud", "AIza[A-Za-z0-9_-]+", least=39),
)
RULES = BASE + MORE


def spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """array<struct<rule, start, end>> of a text, by start, then by the order of the rules."""
    scanner = compile_rules(rules)

    @F.arrow_udf("array<struct<rule: int, start: int, end: int>>")
    def scan(rows: pa.Array) -> pa.Array:
        find = finder(scanner)
        counts, found = [0], []
        for row in rows.cast(pa.binary()):
            data = row.as_py()
            found += in_code_points(data, find(data))
            counts.append(len(found))
        columns = np.array(found, np.int32).reshape(-1, 3).T
        structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["rule", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), structs)

    # Counting and spelling out the spans must not make Spark scan the text again.
    return scan.asNondeterministic()(X.filled(text))


def in_code_points(data: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans in order, their offsets counted in code points; the text between them is read once."""
    place, at, points = {}, 0, 0
    for offset in sorted({offset for _, *both in found for offset in both}):
        points += sum(1 for byte in data[at:offset] if byte & 0xC0 != 0x80) if not data.isascii() else offset - at
        place[offset], at = points, offset
    return sorted(((r, place[s], place[e]) for r, s, e in found), key=lambda span: (span[1], span[0]))


def spelt(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*(F.lit(rule.kind) for rule in rules))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"], s["end"])
    return F.array_join(F.transform(found, one), ",")

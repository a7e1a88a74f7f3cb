"""From Python regular expressions with named groups to Java ones.

Java knows neither ``(?P<name>...)`` nor underscores in group names, so groups are
addressed by number.  A group that took no part in a match comes back empty from
the JVM but missing from Python; for each group it is worked out whether an empty
text can only mean "missing".  Patterns where that is undecidable, or which Java
cannot run, are marked for the Arrow path.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as op
from re import _parser as syntax

from rampart.functions.text import SPACE_CLASS

_JAVA_LACKS = re.compile(r"\(\?\(")  # conditional groups


@dataclass(frozen=True)
class JavaPattern:
    source: str
    java: str
    names: tuple[str, ...]
    numbers: tuple[int, ...]
    # Empty text of this group means that it took no part in the match.
    empty_is_missing: tuple[bool, ...]
    group_count: int
    runs_on_jvm: bool


def to_java(pattern: str) -> JavaPattern:
    compiled = re.compile(pattern)
    groups = sorted(compiled.groupindex.items(), key=lambda item: item[1])
    nullable, optional = _group_traits(pattern)
    java = pattern
    for name, number in groups:
        java = java.replace(f"(?P<{name}>", "(").replace(f"(?P={name})", f"(?:\\{number})")
    java = _escape_in_classes(java.replace(r"\Z", r"\z"))
    undecidable = any(n in nullable and n in optional for _, n in groups)
    return JavaPattern(
        source=pattern,
        java="(?d)" + java,
        names=tuple(name for name, _ in groups),
        numbers=tuple(number for _, number in groups),
        empty_is_missing=tuple(number not in nullable for _, number in groups),
        group_count=compiled.groups,
        runs_on_jvm=not undecidable and not _JAVA_LACKS.search(pattern),
    )


# Java's shorthands are ASCII only, Python's go by Unicode.  The first text is for use
# outside of a character class, the second for inside.
_SHORTHANDS = {
    r"\s": (f"[{SPACE_CLASS}]", SPACE_CLASS),
    r"\S": (f"[^{SPACE_CLASS}]", r"\S"),
    r"\d": (r"\p{Nd}", r"\p{Nd}"),
    r"\D": (r"\P{Nd}", r"\P{Nd}"),
    r"\w": (r"[\p{L}\p{N}_]", r"\p{L}\p{N}_"),
    r"\W": (r"[^\p{L}\p{N}_]", r"\W"),
}


def _escape_in_classes(pattern: str) -> str:
    """Java reads ``[`` and ``&&`` inside a character class as set operators, and its
    shorthands know ASCII only."""
    out, inside, position = [], False, 0
    while position < len(pattern):
        char = pattern[position]
        if char == "\\":
            pair = pattern[position : position + 2]
            out.append(_SHORTHANDS.get(pair, (pair, pair))[inside])
            position += 2
            continue
        if not inside and char == "[":
            inside = True
            # A "]" right after the opening is an ordinary member.
            opening = re.match(r"\[\^?\]?", pattern[position:]).group()
            out.append(opening.replace("]", "\\]"))
            position += len(opening)
            continue
        if inside and char == "]":
            inside = False
        elif inside and char in "[&":
            char = "\\" + char
        out.append(char)
        position += 1
    return "".join(out)


def _group_traits(pattern: str) -> tuple[set[int], set[int]]:
    """Group numbers whose body may match nothing, and those that may be skipped."""
    nullable: set[int] = set()
    optional: set[int] = set()

    def walk(node, skippable: bool) -> None:
        for kind, value in node:
            if kind is op.SUBPATTERN:
                number, body = value[0], value[-1]
                if number is not None:
                    if body.getwidth()[0] == 0:
                        nullable.add(number)
                    if skippable:
                        optional.add(number)
                walk(body, skippable)
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
                walk(value[2], skippable or value[0] == 0)
            elif kind is op.BRANCH:
                for branch in value[1]:
                    walk(branch, True)
            elif kind in (op.ASSERT, op.ASSERT_NOT):
                walk(value[1], skippable or kind is op.ASSERT_NOT)
            elif kind is op.ATOMIC_GROUP:
                walk(value, skippable)
            elif kind is op.GROUPREF_EXISTS:
                for branch in value[1:]:
                    if branch is not None:
                        walk(branch, True)

    walk(syntax.parse(pattern), False)
    return nullable, optional

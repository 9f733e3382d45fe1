"""Regular-expression substitution with a function of the match, as native expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that str.strip() removes.
SPACE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
#: A character of a word: combining marks are none.
WORD = r"[\p{L}\p{N}_]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates value once a row; body gets it as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


#: Noncharacters that Unicode keeps for a program's own use: they mark where a match begins and ends.
OPEN, CLOSE = "\ufdd0", "\ufdd1"


def sub(text: Column, pattern: str, replace: Callable[[Column], Column], *needs: Sequence[str]) -> Column:
    """text with every match m replaced by replace(m). Matches must not be empty. ``needs`` are lists of strings, of each of
    which a text with a match holds one: other texts are passed on without looking for the pattern.

    The pattern runs over a text once, which marks the matches; the marks are single characters, so what follows compiles
    and runs no pattern. A text that has such characters itself loses them where it has a match.
    """

    def of(t: Column) -> Column:
        def parts(marked: Column) -> Column:
            new = lambda x: F.concat(replace(F.substring_index(x, CLOSE, 1)), F.substring_index(x, CLOSE, -1))
            pieces = F.split(marked, OPEN)
            return let(pieces, lambda p: F.when(F.size(p) < 2, t).otherwise(F.concat(F.get(p, F.lit(0)), F.array_join(F.transform(F.slice(p, 2, F.size(p)), new), ""))))

        there = [reduce(lambda a, b: a | b, (t.contains(n) for n in some)) for some in needs]
        done = let(F.regexp_replace(F.when(t.contains(OPEN) | t.contains(CLOSE), F.translate(t, OPEN + CLOSE, "")).otherwise(t), pattern, f"{OPEN}$0{CLOSE}"), parts)
        return F.when(reduce(lambda a, b: a & b, there), done).otherwise(t) if needs else done

    return let(text, of)


def sub_text(text: str, pattern: re.Pattern, replace: Callable[[re.Match], str], needs: Sequence[str]) -> str:
    """sub() of one text, for Python on executors."""
    if not any(n in text for n in needs):
        return text
    done, n = pattern.subn(replace, text.translate(_UNMARKED) if OPEN in text or CLOSE in text else text)
    return done if n else text


_UNMARKED = dict.fromkeys(map(ord, OPEN + CLOSE))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACES))


def group(m: Column, pattern: str, n: int) -> Column:
    return F.regexp_extract(m, pattern, n)

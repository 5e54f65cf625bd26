"""Case-insensitive list replacement, one target after the other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Longer lists go through one array fold instead of nested expressions.
NESTED = 64


def quoted(target: str) -> str:
    """A pattern for the literal target, without regard to case (Unicode)."""
    return "(?iu)\\Q" + target.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def literal_replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def usable(targets: Sequence[str | None], keep_blank: bool = False) -> list[str]:
    """Targets in order with null ones, and unless ``keep_blank`` blank ones, left out."""
    return [t for t in targets if t is not None and (keep_blank or t.strip())]


def independent(targets: Sequence[str], replacement: str) -> bool:
    """Whether no target occurs in another or in the replacement, shares an end with another's start, or is blank: then one
    alternation gives the same as one pass for each target. With an empty replacement the texts on both sides of a match
    meet and may make up a later target, so it never does."""
    if not replacement:
        return False
    low, inserted = [t.casefold() for t in targets], replacement.casefold()

    def touches(a: str, b: str) -> bool:
        return bool(a and b) and (a in b or b in a or any(a[-k:] == b[:k] or b[-k:] == a[:k] for k in range(1, min(len(a), len(b)))))

    return all(t and not touches(t, inserted) for t in low) and not any(touches(a, b) for i, a in enumerate(low) for b in low[:i])


def replace_strings(text: Column, targets: Sequence[str | None], replacement: str, keep_blank: bool = False) -> Column:
    """Every occurrence of each target replaced, in the order of the list: later targets see earlier replacements.

    The replacement is literal; one with a backslash is refused, as it would be a template elsewhere.
    """
    if "\\" in replacement:
        raise ValueError("the replacement is literal text and may not hold a backslash")
    wanted, new = usable(targets, keep_blank), literal_replacement(replacement)
    if not wanted:
        return text
    if len(wanted) > 1 and len(wanted) <= 256 and independent(wanted, replacement):
        return F.regexp_replace(text, "|".join(quoted(t) for t in wanted), new)
    if len(wanted) <= NESTED:
        return reduce(lambda t, target: F.regexp_replace(t, F.lit(quoted(target)), F.lit(new)), wanted, text)
    patterns = F.array(*[F.lit(quoted(t)) for t in wanted])
    folded = F.aggregate(patterns, text, lambda t, p: F.regexp_replace(t, p, F.lit(new)))
    # one scan by all targets, compiled once, decides whether the fold (which compiles each pattern again) is needed
    return F.when(text.rlike("|".join(quoted(t) for t in wanted)), folded).otherwise(text)


class Replacer:
    """The list and its replacement as an object: ``Replacer(targets, replacement).replace(column)``."""

    def __init__(self, targets: Sequence[str | None], replacement: str, keep_blank: bool = False):
        self.targets, self.replacement, self.keep_blank = list(targets), replacement, keep_blank

    def replace(self, text: Column) -> Column:
        return replace_strings(text, self.targets, self.replacement, self.keep_blank)

"""Text expressions. Word sets split at white space and keep punctuation: "pump." is not "pump"."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any script, as Python's strip and split know it; in regular expressions \\s is ASCII only.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same for Java, which tries the parts of a class one by one: one range stands before the rare ones.
SPACE_JAVA = r"[\t-\r\x1c-\x20\x{85}\x{a0}[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]"
SPACES = "".join(chr(i) for a, b in [(9, 13), (28, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)] for i in range(a, b + 1))


def strip(c: Column) -> Column:
    """Without white space at both ends; trim without a list only removes spaces."""
    return F.btrim(c, F.lit(SPACES))


def words(c: Column) -> Column:
    return F.filter(F.split(c, SPACE_JAVA + "+"), lambda x: x != "")


def word_set(c: Column) -> Column:
    """Distinct lower-cased words; empty for null."""
    return F.array_distinct(words(F.lower(F.coalesce(c, F.lit("")))))


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, which is evaluated once, however often f reads it: Spark would write it out at every place in a CASE or a filter."""
    return F.get(F.transform(F.array(c), f), 0)


def shared_words(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(word_set(a), word_set(b)))


def is_upper(c: Column) -> Column:
    """At least one upper-case letter and no lower-case one."""
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}")


def after_first(c: Column, mark: str) -> Column:
    """What follows the first mark; null where there is none."""
    at = F.instr(c, mark)
    return F.when(at > 0, c.substr(at + F.lit(len(mark)), F.length(c)))


def ordered_text(order: list[str], text: str, sep: str) -> Column:
    """Aggregate: the texts of a group in the order of the columns, joined by sep."""
    rows = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("_t"))))
    return F.array_join(F.transform(rows, lambda r: r["_t"]), sep)

"""Expressions over one issue or one event, as Spark SQL text.

Each builder takes SQL expressions (usually column names) and returns one, for
``F.expr`` and ``selectExpr``; an expression built as text costs the driver one
call, however many words or branches it has.
"""

from tracklens.schema import BANDS, NO_LABEL, PRIORITIES

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 24 * MICROS_PER_HOUR
FENCE = "```"
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def literal(text: str) -> str:
    """``text`` as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def one_of(value: str, texts: list[str]) -> str:
    """Whether ``value`` is among ``texts``; false for NULL."""
    if not texts:
        return "false"
    return f"coalesce({value} IN ({', '.join(map(literal, texts))}), false)"


# --- time ------------------------------------------------------------------------

def micros_between(start: str, end: str) -> str:
    """Signed microseconds from ``start`` to ``end``."""
    return f"(unix_micros({end}) - unix_micros({start}))"


def hours(micros: str) -> str:
    return f"({micros} / {MICROS_PER_HOUR}D)"


def days(micros: str) -> str:
    return f"({micros} / {MICROS_PER_DAY}D)"


def mean_micros(micros: str) -> str:
    """Exact mean: whole seconds and rests are summed as integers, so the result
    does not depend on partition order and the sums do not overflow."""
    rest = f"pmod({micros}, {MICROS_PER_SECOND})"
    seconds = f"(({micros} - {rest}) div {MICROS_PER_SECOND})"
    return f"((sum({seconds}) * {MICROS_PER_SECOND}D + sum({rest})) / count({micros}))"


def whole_days(start: str, end: str) -> str:
    """Elapsed whole days, rounded down (not calendar days)."""
    micros = micros_between(start, end)
    return f"(({micros} - pmod({micros}, {MICROS_PER_DAY})) div {MICROS_PER_DAY})"


def day_of_week(ts: str) -> str:
    """0 = Monday."""
    return f"weekday({ts})"


def day_hour(ts: str) -> str:
    """(dow, hour) of a time, NULL for NULL."""
    return f"if({ts} IS NULL, NULL, named_struct('dow', weekday({ts}), 'hour', hour({ts})))"


# --- labels and text -----------------------------------------------------------------

def contains_any(text: str, words: list[str]) -> str:
    """Whether lower-cased ``text`` holds any of ``words``; false for NULL."""
    lowered = f"lower(coalesce({text}, ''))"
    return "(" + " OR ".join(f"contains({lowered}, {literal(word)})" for word in words) + ")"


def label_list(labels: str) -> str:
    return f"coalesce({labels}, CAST(array() AS array<string>))"


def has_label(labels: str, *words: str) -> str:
    """Whether any label contains any of the words, ignoring the label's case."""
    return f"exists({label_list(labels)}, one -> {contains_any('one', list(words))})"


def count_labels_with(labels: str, words: list[str]) -> str:
    return f"size(filter({label_list(labels)}, one -> {contains_any('one', words)}))"


def labels_or_none(labels: str) -> str:
    """The labels, or the single stand-in for an issue without any."""
    present = label_list(labels)
    return f"if(size({present}) > 0, {present}, array({literal(NO_LABEL)}))"


def flag(condition: str) -> str:
    return f"CAST({condition} AS int)"


def fence_count(body: str) -> str:
    """Non-overlapping code fences."""
    text = f"coalesce({body}, '')"
    return (f"((length({text}) - length(replace({text}, {literal(FENCE)}, ''))) "
            f"div {len(FENCE)})")


def words_of(text: str) -> str:
    """Lower-cased runs of two or more letters, digits or underscores."""
    return f"regexp_extract_all(lower(coalesce({text}, '')), {literal(WORD_PATTERN)}, 0)"


def label_category(label: str) -> str:
    kinds = [("Bug", ["bug"]), ("Feature/Enhancement", ["feature", "enhancement"]),
             ("Documentation", ["doc"]), ("Area", ["area/"])]
    branches = " ".join(
        f"WHEN {contains_any(label, words)} THEN {literal(name)}" for name, words in kinds)
    return f"CASE {branches} ELSE 'Other' END"


# --- scores ------------------------------------------------------------------------------

def points_above(value: str, steps: list[tuple[float, int]]) -> str:
    """Points of the first bound exceeded, else 0."""
    branches = " ".join(f"WHEN {value} > {bound} THEN {points}" for bound, points in steps)
    return f"CASE {branches} ELSE 0 END"


def points_from(value: str, steps: list[tuple[float, int]]) -> str:
    """Points of the first bound reached, else 0."""
    branches = " ".join(f"WHEN {value} >= {bound} THEN {points}" for bound, points in steps)
    return f"CASE {branches} ELSE 0 END"


def in_band(score: str, name: str) -> str:
    """Whether a complexity score falls in the named band."""
    lows = dict(BANDS)
    higher = [low for low in lows.values() if low > lows[name]]
    top = min(higher) if higher else 101
    return f"({score} >= {lows[name]} AND {score} < {top})"


def complexity_band(score: str) -> str:
    branches = " ".join(f"WHEN {in_band(score, name)} THEN {literal(name)}" for name, _ in BANDS)
    return f"CASE {branches} END"


def priority_order(priority: str) -> str:
    """Critical 4 down to Low 1, anything else 0."""
    branches = " ".join(
        f"WHEN {literal(name)} THEN {place}" for place, name in enumerate(reversed(PRIORITIES), 1))
    return f"CASE {priority} {branches} ELSE 0 END"


def percent(part: str, whole: str) -> str:
    """100 * part / whole, 0 for an empty whole."""
    return f"if({whole} > 0, {part} * 100D / {whole}, 0D)"

"""Secret scan with a random forest against false positives (operator 8), in SQL functions alone.

A regular expression marks candidates in place: long runs of key characters with a digit or
in mixed case, and whatever a cue word is assigned, or is followed by in quotes, of any
alphabet from 4 characters on. Each gets figures on its length, changes of
character class, distinct characters, dictionary coverage, paths and neighbouring words. A
random forest trained on labelled findings then votes; its trees are written as SQL
conditions, so a whole scan is one pass over the texts without joins or Python.
"""

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.storage import stored

_CHAR = "[A-Za-z0-9_+/-]"
_RUN = (f"(?<!{_CHAR})(?:(?=[A-Za-z_+/-]*[0-9]){_CHAR}{{16,}}|[A-Z0-9]{{20,}}"
        f"|(?=[A-Z_+/-]*[a-z][a-z_+/-]*[A-Z]){_CHAR}{{16,}})(?!{_CHAR})")
NEAR = 24  # characters looked at on either side
LEAD = 96  # characters in which a cue word, the rest of its name and what assigns a value must stand

# After a cue word: the rest of a name, then a sign that assigns, or up to two words before a quote.
_NAME = r"(?:s|[0-9]{1,4}|[_-][A-Za-z0-9_-]{0,24}|[A-Z][A-Za-z0-9_-]{0,24})?"
_SIGN = r"[\x22\x27`\])]{0,2}\s{0,3}(?::=|=>|={1,2}|:)[ \t]{0,3}"
_GAP = r"\s{1,3}(?:[A-Za-z]{1,10}\s(?:[A-Za-z]{1,10}\s)?)?"
# What is assigned without quotes ends before white space or a quote, closing punctuation, or the next assignment.
_BARE = (r"[^\s\x22\x27`<>=:][^\s\x22\x27`<>]{3,}?(?=[.,;:)\]}]{0,3}(?:[\s\x22\x27`<>]|$)|[,;&]\w{1,40}(?: \w{1,40})?=)")

# Words that announce a secret, and common parts of words and placeholders.
CUES = "password passwd pwd secret token credential apikey api_key api-key access_key auth bearer private".split()
DICTIONARY = ("example sample test dummy placeholder changeme default token secret password public version "
              "number tion ment that with this from the and ing lich ung der ent que ado ion").split()



def _cue(cues) -> str:
    return f"(?:(?i:{'|'.join(map(re.escape, cues))}){_NAME})"


def candidate(cues=CUES) -> str:
    """The regular expression that marks candidates; cheap looks behind stand before dear ones."""
    quoted = "|".join(
        f"(?<={q})(?<={_cue(cues)}(?:{_SIGN}|{_GAP}){q})(?:[^{q}\\s]{{4,}}+|[^{q}\\r\\n]{{4,64}})(?={q})"
        for q in (r"\x22", r"\x27", "`"))
    bare = f"(?<=[=:> \\t])(?<=[=:>][ \\t]{{0,3}})(?<={_cue(cues)}{_SIGN}){_BARE}"
    return f"{quoted}|{bare}|{_RUN}"


# Name and SQL of each figure, in terms of c.value, c.before and c.after.
FEATURES = {
    "length": "length(c.value)",
    "digits": "length(regexp_replace(c.value, '[^0-9]', '')) / length(c.value)",
    "upper": "length(regexp_replace(c.value, '[^A-Z]', '')) / length(c.value)",
    "hexadecimal": "length(regexp_replace(c.value, '[^0-9a-f]', '')) / length(c.value)",
    "changes": "length(regexp_replace(c.value, '[a-z]+|[A-Z]+|[0-9]+|[_+/-]+', 'x')) / length(c.value)",
    "distinct": "size(array_distinct(split(c.value, ''))) / least(length(c.value), 40)",
    "vowels": "length(regexp_replace(c.value, '[^aeiouAEIOU]', '')) / length(c.value)",
    "dictionary": "1 - length(regexp_replace(lower(c.value), '{words}', '')) / length(c.value)",
    "path": "cast(c.value LIKE '%/%' OR rtrim(c.before) RLIKE '[/.\\\\\\\\]$' OR c.after RLIKE '^[/.]' AS double)",
    "cue": "cast(lower(c.before) RLIKE '({cues})' AS double)",
    "assigned": "cast(c.before RLIKE '[=:] ?[\"'']?$' AS double)",
    "given": "cast(c.lead RLIKE '{given}' AS double)",
    "symbols": "length(regexp_replace(c.value, '[A-Za-z0-9_+/-]', '')) / length(c.value)",
    "quoted": "cast(c.before RLIKE '[\"'']$' AND c.after RLIKE '^[\"'']' AS double)",
}
# A word that a cue word happens to be assigned, a variable's name and an address are no secrets.
WEAK_LABEL = ("CASE WHEN c.value RLIKE '^(AKIA|ASIA)[A-Z0-9]{{16}}$' THEN 1 "
              "WHEN (lower(c.before) RLIKE '({cues})[\"'']? ?[=:] ?[\"'']?$' OR c.lead RLIKE '{given}') "
              "AND NOT c.value RLIKE '^[0-9]+$' AND c.value RLIKE '{keylike}' AND NOT c.value RLIKE '{named}' THEN 1 "
              "ELSE 0 END")
_KEYLIKE = r"[0-9]|[a-z][A-Z]|^[A-Z]{20,}$|[!#$%^&*+=~?|@][A-Za-z0-9]"
_NAMED = r"^(?:[$%]?[{(<\[]|%\w+%$|\w+://)|^[^@\s]+@[A-Za-z0-9-]+[.][A-Za-z0-9.-]+$"


def _sql(text: str, cues, dictionary) -> str:
    given = f"{_cue(cues)}(?:{_SIGN}[\\x22\\x27`]?|{_GAP}[\\x22\\x27`])$"
    return text.format(cues="|".join(map(re.escape, cues)).replace("\\", "\\\\"),
                       given=given.replace("\\", "\\\\"), keylike=_KEYLIKE, named=_NAMED.replace("\\", "\\\\"),
                       words="|".join(sorted(map(re.escape, dictionary), key=len, reverse=True)).replace("\\", "\\\\"))


def marked(docs: DataFrame, *, cues=CUES, dictionary=DICTIONARY) -> DataFrame:
    """Add ``_parts`` (text between candidates and candidates, in turn) and ``_found`` with their figures."""
    mark = F.when(F.instr("text", "\x01") == 0, F.lit("\x01")).otherwise(
        F.concat(F.lit("\x01"), F.md5(F.col("text").cast("binary"))))
    turns = docs.withColumn("_mark", mark).withColumn("_parts", F.split(
        F.regexp_replace("text", F.lit(candidate(cues)), F.concat("_mark", F.lit("$0"), "_mark")), F.col("_mark")))
    figures = ", ".join(f"'{name}', cast({_sql(text, cues, dictionary)} AS double)" for name, text in FEATURES.items())
    # a key's name may be a candidate of its own: what stands before goes back beyond it
    lead = (f"right(concat(right(coalesce(get(_parts, i - 3), ''), {LEAD}), right(coalesce(get(_parts, i - 2), ''), {LEAD}), "
            f"right(_parts[i - 1], {LEAD})), {LEAD})")
    raw = F.expr("transform(filter(sequence(0, size(_parts) - 1), i -> i % 2 = 1), "
                 f"i -> named_struct('at', i, 'value', _parts[i], 'lead', {lead}, "
                 f"'before', right({lead}, {NEAR}), 'after', left(_parts[i + 1], {NEAR})))")
    found = F.expr(f"transform(_raw, c -> named_struct('at', c.at, 'value', c.value, {figures}, "
                   f"'labelled', {_sql(WEAK_LABEL, cues, dictionary)}))")
    some = F.when(F.size("_parts") > 1, raw)
    return turns.withColumn("_raw", some).withColumn("_found", F.when(F.col("_raw").isNotNull(), found)).drop(
        "_mark", "_raw")


def labelled_findings(docs: DataFrame, *, most: int = 20_000, **words) -> DataFrame:
    """Findings with figures and ``labelled`` (1 secret, 0 not), about ``most`` chosen by a hash.

    Labels follow strict rules: keys of a known make, and what a cue word is assigned. The
    marked findings are written before anything filters them: a filter in the same plan is
    pushed below the columns it reads and repeats the candidate expression in each.
    """
    once = stored(marked(docs.select("text"), **words).select("_found"), "marked")
    found = once.filter("_found IS NOT NULL").select(F.explode("_found").alias("c")).select("c.*")
    counts = {row.labelled: row.n for row in
              found.groupBy("labelled").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("labelled") == 1, min(1.0, most / 2 / max(counts.get(1, 0), 1))).otherwise(
        min(1.0, most / 2 / max(counts.get(0, 0), 1)))
    place = F.pmod(F.xxhash64("value", *FEATURES), F.lit(1 << 20)) / float(1 << 20)
    return found.filter(place < share)


def _condition(tree: str) -> str:
    """A tree's printed form as nested SQL conditions on c."""
    lines = [line.strip() for line in tree.splitlines() if re.match(r"\s*(If|Else|Predict)", line)]
    names, at = list(FEATURES), 0

    def read() -> str:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict"):
            return f"{float(line.split(':')[1])}D"
        feature, limit = re.match(r"If \(feature (\d+) <= ([^)]+)\)", line).groups()
        left = read()
        at += 1  # Else
        return f"CASE WHEN c.{names[int(feature)]} <= {float(limit)!r}D THEN {left} ELSE {read()} END"

    return read()


def train(findings: DataFrame, *, trees: int = 16, depth: int = 5, seed: int = 9) -> str:
    """SQL of the share of trees that take a candidate c for a secret.

    ``findings``: the columns of FEATURES and ``labelled``. With labels of one kind only, all
    candidates get that kind's score, without any 0.
    """
    rows = stored(findings.select(*FEATURES, F.col("labelled").cast("double").alias("label")).fillna(0.0), "findings")
    kinds = {row.label for row in rows.select("label").distinct().collect()}
    if len(kinds) < 2:
        return f"{max(kinds, default=0.0)}D"
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label").fit(vectors)
    votes = " + ".join(_condition(tree.toDebugString) for tree in forest.trees)
    return f"({votes}) / {len(forest.trees)}"


def scan(docs: DataFrame, score: str, *, threshold: float = 0.5, mask: str = "[SECRET]", **words) -> DataFrame:
    """Add ``findings`` (value and score of each candidate, in order), ``n_secrets`` and ``redacted``.

    ``docs`` needs ``text``; its other columns stay, but for ones of the added names, which
    are replaced. Candidates whose score (SQL from :func:`train`) reaches ``threshold`` are
    secrets and are masked in ``redacted``; nothing else of a text changes. A null text stays
    null; it and a text without candidates have no findings. A very long text is scanned whole,
    in one row; repeated rows are scanned each for itself.
    """
    rated = F.expr(f"transform(_found, c -> named_struct('at', c.at, 'value', c.value, 'score', {score}))")
    redacted = F.expr("array_join(transform(_parts, (part, i) -> CASE WHEN exists(findings, "
                      f"f -> f.at = i AND f.score >= {threshold}D) THEN '{mask}' ELSE part END), '')")
    others = [c for c in docs.columns if c not in ("findings", "n_secrets", "redacted")]
    full = marked(docs.select("text", F.struct(*others).alias("_row")), **words).withColumn("findings", F.when(F.col("_found").isNotNull(), rated))
    full = full.withColumn("n_secrets", F.when(F.col("findings").isNotNull(), F.size(F.filter(
        "findings", lambda f: f.score >= threshold))).otherwise(0).cast("int"))
    full = full.withColumn("redacted", F.when(F.col("n_secrets") > 0, redacted).otherwise(F.col("text")))
    plain = F.transform("findings", lambda f: F.struct(f.value.alias("value"), f.score.alias("score")))
    none = F.expr("cast(array() AS array<struct<value:string,score:double>>)")
    return full.select(*[F.col("_row").getField(c).alias(c) for c in others],
                       F.coalesce(plain, none).alias("findings"), "n_secrets", "redacted")


def without_secrets(docs: DataFrame) -> DataFrame:
    """Train on the corpus's own labelled findings and scan it."""
    return scan(docs, train(labelled_findings(docs)))

"""Quality rules kept as a ledger of failure bits.

Every rule is evaluated once a document; the ledger stores one failure bit a rule beside the
measurements the rules look at. Which rules reject is a policy, a named and versioned mask: it is
applied to the ledger without reading a text again, and what each rule does in it (an ablation) is
worked out from counts by bit pattern, of which there are at most 2^rules.

Everything is built-in expressions on one row: no text is exploded or shuffled. A text's words are
bound once (``_let``), so that no expression splits them again for each of its elements.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_name, table

WINDOW = 8  # words of a repeated passage
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule by name; ``fails`` is a condition on the columns of ``MEASURES``."""

    name: str
    fails: Callable[[dict[str, Column]], Column]


#: The rules in the order of their bits; new ones are appended, so that stored bits keep their meaning.
RULES = (
    Rule("few_words", lambda m: m["n_words"] < 20),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda m: (100 * m["n_dup_lines"] > 30 * m["n_lines"]) & (m["n_lines"] > 3)),
    Rule("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 20 * m["n_words"]),
    Rule("few_letters", lambda m: 2 * m["n_letters"] < m["word_chars"]),
    Rule("bullets", lambda m: (100 * m["n_bullet_lines"] > 90 * m["n_lines"]) & (m["n_lines"] > 1)),
    Rule("cut_off_lines", lambda m: (100 * m["n_cut_lines"] > 60 * m["n_lines"]) & (m["n_lines"] > 1)),
    Rule("stuttering", lambda m: 2 * m["n_stutters"] > m["n_words"]),
)
BASE = ("few_words", "repeated_words")
#: Policies by name and version: the rules that reject.
POLICIES = {
    "base-1": BASE,
    "web-1": (*BASE, "symbols", "repeated_lines"),
    "web-2": tuple(r.name for r in RULES),
}
POLICY = "web-2"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_bullet_lines", "n_cut_lines", "n_stutters")


def mask(names) -> int:
    """The bits of some rules."""
    at = {r.name: k for k, r in enumerate(RULES)}
    return sum(1 << at[n] for n in set(names))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _window_hashes(words: Column) -> Column:
    """A hash of each window of ``WINDOW`` words: of pairs, of pairs of those, and so on."""
    def joined(span: int) -> Callable[[Column], Column]:
        return lambda h: F.zip_with(F.slice(h, 1, F.greatest(F.size(h) - span, F.lit(0))), F.slice(h, span + 1, F.size(h)), lambda a, b: F.xxhash64(a, b))

    hashes, span = words, 1
    while span < WINDOW:
        hashes = _let(hashes, joined(span))
        span *= 2
    return hashes


def _repeated_words(words: Column, hashes: Column) -> Column:
    """Words in windows of ``WINDOW`` words that stand twice or more in the text.

    Hashes only rule windows out: where all hashes differ none repeats; else the windows whose
    hash repeats are compared by their words.
    """
    def doubles(keyed: Column) -> Column:
        """Of a sorted array of (key, at) those whose key is a neighbour's too."""
        return F.filter(keyed, lambda x, i: (x["key"] == F.get(keyed, i - 1)["key"]) | (x["key"] == F.get(keyed, i + 1)["key"]))

    def covered(at: Column) -> Column:
        """Words that windows at these sorted places cover."""
        each = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)

    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("key"), i.alias("at"))))
    maybe = _let(keyed, doubles)
    text = lambda at: F.concat_ws(" ", *[F.get(words, at + k) for k in range(WINDOW)])  # noqa: E731  (a slice would copy all words each time)
    exact = F.sort_array(F.transform(maybe, lambda x: F.struct(text(x["at"]).alias("key"), x["at"].alias("at"))))
    places = F.sort_array(F.transform(_let(exact, doubles), lambda x: x["at"]))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(_let(places, covered))


def measured(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with columns of ``MEASURES`` (long) of each whole text, and those by measure; null has none of anything.

    Each projection names what the one below makes more than once, so Catalyst doesn't merge them
    and every value is worked out once a row.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = {n: fresh_name(docs, n) for n in ("words", "lines", "chars", "others", "hashes", *MEASURES)}
    words, lines, chars, others, hashes = (F.col(name[n]) for n in ("words", "lines", "chars", "others", "hashes"))
    rows = docs.withColumns({
        name["words"]: F.array_remove(F.split(text, SPACES), ""),
        name["lines"]: F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        name["chars"]: F.length(text),
        name["others"]: F.regexp_replace(text, r"[\p{L}\p{M}]+", "")})  # all that aren't letters, which is little
    rows = rows.withColumn(name["hashes"], _window_hashes(words))
    made = {
        "n_words": F.size(words),
        "word_chars": chars - F.length(F.regexp_replace(others, r"[^\x20\x09-\x0D]+", "")),
        "n_symbols": F.length(F.regexp_replace(others, f"[^{SYMBOLS}]+", "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated_words(words, hashes),
        "n_lines": F.size(lines),
        "n_letters": chars - F.length(others),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\x09]*[-*•‣▪·]"))),
        "n_cut_lines": F.size(F.filter(lines, lambda x: F.endswith(F.rtrim(x), F.lit("...")) | F.endswith(F.rtrim(x), F.lit("…")))),
        "n_stutters": F.size(F.filter(F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: a.eqNullSafe(b)), lambda same: same)),
    }
    rows = rows.withColumns({name[n]: made[n].cast("long") for n in MEASURES})
    return rows.drop(*[name[n] for n in ("words", "lines", "chars", "others", "hashes")]), {n: F.col(name[n]) for n in MEASURES}


def ledger(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, bits (long; one failure bit a rule), and ``MEASURES``.

    Null and blank texts have measurements of zero (so they fail ``few_words`` alone); null ids
    stay null; repeated rows give repeated rows; other columns are ignored, whatever their names;
    an empty table gives no rows.
    """
    rows, m = measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return rows.select("doc_id", _bits(m).alias("bits"), *[c.alias(n) for n, c in m.items()])


def _bits(measures: dict[str, Column]) -> Column:
    """A long with one bit a rule that fails."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(r.fails(measures), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, r in enumerate(RULES)])


def apply_policy(entries: DataFrame, policy: str = POLICY, column: str = "kept") -> DataFrame:
    """A ledger with a boolean column: whether none of the policy's rules fails."""
    return entries.withColumn(column, F.col("bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def patterns(entries: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows by bit pattern (and ``by``): bits, rows; reduced before the shuffle. Ablations need no more of a ledger."""
    return entries.groupBy(*by, "bits").agg(F.count(F.lit(1)).alias("rows"))


def ablations(counts: DataFrame, policies: dict[str, tuple[str, ...]] | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """What each rule does in each policy, from ``patterns``.

    policy, rule, rows, failed (the rule's bit is set), rejected (by the whole policy), alone
    (rejected by this rule only: kept without it), together (bits of the policy's rules that fail
    beside it in some row). A rule that isn't in the policy gives no row; an empty ledger gives none.
    """
    cases = [(p, n, mask(names), mask([n])) for p, names in (policies or POLICIES).items() for n in names]
    case = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(n).alias("rule"), F.lit(m).cast("long").alias("mask"), F.lit(b).cast("long").alias("bit")) for p, n, m, b in cases]))
    hit = counts.select(*by, "bits", "rows", case.alias("c")).select(*by, "bits", "rows", "c.*").withColumn("failing", F.col("bits").bitwiseAND(F.col("mask")))
    some = lambda condition: F.sum(F.when(condition, F.col("rows")).otherwise(0))
    mine = F.col("failing").bitwiseAND(F.col("bit")) != 0
    return hit.groupBy("policy", "rule", *by).agg(
        F.sum("rows").alias("rows"), some(mine).alias("failed"), some(F.col("failing") != 0).alias("rejected"), some(F.col("failing") == F.col("bit")).alias("alone"),
        F.coalesce(F.bit_or(F.when(mine, F.col("failing").bitwiseXOR(F.col("bit")))), F.lit(0).cast("long")).alias("together"))


def keep_by_rules(docs: DataFrame, policy: str = POLICY) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, with all their columns; edge cases as in ``ledger``."""
    rows, m = measured(docs)
    bits = fresh_name(rows, "bits")
    # A one-row generator: a filter isn't pushed below it, where it would work the measurements out again.
    judged = rows.select(*[F.col(c) for c in docs.columns], F.explode(F.array(_bits(m))).alias(bits))
    return judged.where(F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0).drop(bits)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = apply_policy(apply_policy(ledger(table(spark, sf_dir, "documents"))), "base-1", "base_kept")
    return entries.select("doc_id", *MEASURES[:5], (~F.col("base_kept")).alias("base_failed"), "kept", "bits", *MEASURES[5:])


ORACLE = r"""
with texts as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
split as (
  select rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from texts),
windows as (
  select rid, i, list_slice(words, i, i + 7) as w
  from (select rid, words, unnest(range(1, len(words) - 6)) as i from split where len(words) >= 9)),
doubles as (
  select rid, i from (select rid, i, count(*) over (partition by rid, w) as c from windows) where c > 1),
covered as (
  select rid, cast(sum(least(8, coalesce(following - i, 8))) as bigint) as n
  from (select rid, i, lead(i) over (partition by rid order by i) as following from doubles) group by rid),
measured as (
  select doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
         cast(len(lines) as bigint) as n_lines, cast(length(regexp_replace(text, '[^\p{L}\p{M}]+', '', 'g')) as bigint) as n_letters,
         cast(len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•‣▪·]'))) as bigint) as n_bullet_lines,
         cast(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) as bigint) as n_cut_lines,
         cast(len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) as bigint) as n_stutters
  from split left join covered using (rid)),
judged as (
  select *, cast(n_words < 20 as bigint) + 2 * cast(100 * n_repeat_words > 30 * n_words as bigint) + 4 * cast(10 * n_symbols > n_words as bigint)
    + 8 * cast(100 * n_dup_lines > 30 * n_lines and n_lines > 3 as bigint) + 16 * cast(word_chars < 2 * n_words as bigint) + 32 * cast(word_chars > 20 * n_words as bigint)
    + 64 * cast(2 * n_letters < word_chars as bigint) + 128 * cast(100 * n_bullet_lines > 90 * n_lines and n_lines > 1 as bigint)
    + 256 * cast(100 * n_cut_lines > 60 * n_lines and n_lines > 1 as bigint) + 512 * cast(2 * n_stutters > n_words as bigint) as bits from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 as base_failed, bits = 0 as kept, bits,
       n_lines, n_letters, n_bullet_lines, n_cut_lines, n_stutters from judged
"""

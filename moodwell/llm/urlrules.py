"""URL filters: pattern rules indexed by their rarest literal token.

A rule is read in one of two ways. An *address* rule, like ``example.net/en/``, fits its host and
all subdomains of it where the path starts with the rule's, in that case of letters. A *pattern*
rule, in any case of letters, fits a part of the address: ``*`` stands for any characters, ``^``
for one that is no ASCII letter or digit, or for an end of the address, ``|`` at either end for that
end, ``||`` at the start for the start of the host or of one of its labels.

Tokens are runs of ASCII letters and digits. Each rule is kept under one token that every address
it fits must hold as a whole: of these, the one that fewest addresses hold. The tokens of an
address fetch the rules kept under them, and only for those the regular expression runs. A rule
without such a token is kept under the empty token, which every address holds. A token that many
addresses hold is dealt to several tasks.

Of the address rules that fit, the longest decides, of equal ones that which allows; without any,
the pattern rules do so in the same way; else the default holds.

Defined results: a null address, an empty one and one without ``://`` have an empty host and path;
only patterns that fit an empty address fit them. Rows equal in everything are kept, each with its
result; null ids are ordinary ids; an empty table gives an empty result; without rules the default
holds; addresses are read whole; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodwell.llm.common import lower_ascii, sent_if_small, written

ALLOW, BLOCK = "allow", "block"
ADDRESS, PATTERN = "address", "pattern"
#: A token with more than this part of all tokens that rules are kept under is dealt out.
PART = 1000

HOSTS = r"\A[^/?#]*"
TOKEN = "[a-z0-9]+"
WHOLE_TOKEN = f"(?<![a-z0-9*]){TOKEN}(?![a-z0-9*])"
LABEL_START = r"\A(?:[^/?#]*\.)?"
BOUNDARY = r"(?:[^A-Za-z0-9]|\A|\z)"

# The address rules of the contract.
ADDRESS_RULES = [(BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/")]

# Patterns for what is seldom wanted in training texts, and for two pages that are.
PATTERN_RULES = [
    (BLOCK, "^adult^"),
    (BLOCK, "^porn^"),
    (BLOCK, "^casino^"),
    (BLOCK, "^poker^"),
    (BLOCK, "^bets^"),
    (BLOCK, "^pills^"),
    (BLOCK, "^spam^"),
    (BLOCK, "||ads^"),
    (BLOCK, "||ads-track^"),
    (BLOCK, "?sessionid=*"),
    (BLOCK, ".exe|"),
    (ALLOW, "||*.edu^wiki^*casino^"),
    (ALLOW, "^encyclopedia^*poker^"),
]


def rule_table(
    spark: SparkSession,
    addresses: list[tuple[str, str]] = ADDRESS_RULES,
    patterns: list[tuple[str, str]] = PATTERN_RULES,
) -> DataFrame:
    """``kind, verdict, rule`` of rules given as pairs of verdict and rule."""
    rows = [(ADDRESS, *r) for r in addresses] + [(PATTERN, *r) for r in patterns]
    return spark.createDataFrame(rows, "kind string, verdict string, rule string")


def _quoted(literal: Column) -> Column:
    return F.regexp_replace(literal, r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])", r"\\$1")


def compiled(rules: DataFrame) -> DataFrame:
    """The rules with their regular expression and the tokens that they could be kept under."""
    rule = F.col("rule")
    host = lower_ascii(F.regexp_extract(rule, "(?s)^[^/]*", 0))
    path = F.regexp_extract(rule, "(?s)^[^/]*(.*)$", 1)
    ending = F.when(path == "", F.lit(r"(?:/|\z)")).otherwise(_quoted(path))
    of_address = F.concat(F.lit(LABEL_START), _quoted(host), ending)
    # What stands open at an end or beside a star may go on in the address.
    shape_of_address = F.concat(F.lit("/"), host, F.when(path == "", "/").otherwise(F.concat(path, F.lit("*"))))

    body = F.regexp_replace(rule, r"(?s)^\|{1,2}|\|$", "")
    start = (
        F.when(rule.startswith("||*"), "")
        .when(rule.startswith("||"), F.lit(LABEL_START))
        .when(rule.startswith("|"), r"\A")
        .otherwise("")
    )
    # A star at an open end says nothing, but would be tried at every place.
    ends = F.when(rule.rlike(r"^\|[^|]"), r"^$").otherwise(r"^\*+")
    ends = F.concat(ends, F.when(rule.endswith("|"), "").otherwise(r"|\*+$"))
    literal = _quoted(F.regexp_replace(body, ends, F.lit("")))
    inner = F.replace(F.replace(literal, F.lit(r"\*"), F.lit(".*")), F.lit(r"\^"), F.lit(BOUNDARY))
    of_pattern = F.concat(F.lit("(?si)"), start, inner, F.when(rule.endswith("|"), r"\z").otherwise(""))
    shape_of_pattern = F.concat(
        F.when(rule.startswith("|"), "/").otherwise("*"), body, F.when(rule.endswith("|"), "/").otherwise("*")
    )

    is_address = F.col("kind") == ADDRESS
    shape = lower_ascii(F.when(is_address, shape_of_address).otherwise(shape_of_pattern))
    tokens = F.array_distinct(F.regexp_extract_all(shape, F.lit(WHOLE_TOKEN), F.lit(0)))
    return rules.where(rule.isNotNull()).distinct().select(
        "kind",
        "verdict",
        "rule",
        F.when(is_address, of_address).otherwise(of_pattern).alias("regex"),
        F.when(F.size(tokens) > 0, tokens).otherwise(F.array(F.lit(""))).alias("tokens"),
    )


def parsed(df: DataFrame, id_column: str, url_column: str) -> DataFrame:
    """``row`` (a number of its own), ``id, host, path, rest`` (all behind the host) of every row."""
    behind = F.regexp_extract(F.coalesce(F.col(url_column), F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    rest = F.regexp_replace(F.col("behind"), HOSTS, "")
    return df.select(F.col(id_column).alias("id"), behind.alias("behind")).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        lower_ascii(F.regexp_extract("behind", HOSTS, 0)).alias("host"),
        F.regexp_extract(rest, r"\A[^?#]*", 0).alias("path"),
        rest.alias("rest"),
    )


def _tokens(address: Column) -> Column:
    found = F.regexp_extract_all(lower_ascii(address), F.lit(TOKEN), F.lit(0))
    return F.array_distinct(F.concat(found, F.array(F.lit(""))))


def filter_urls(
    df: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = ALLOW,
) -> DataFrame:
    """``host, path``, the address rule that decides, the verdict and the pattern that fits, if any,
    of every row. Runs jobs at once: the addresses, the rules and their index are written."""
    rows = written(parsed(df, id_column, url_column), "addresses")
    read = written(compiled(rules), "rules")
    held = rows.select("row", "host", "path", "rest", F.explode(_tokens(F.concat("host", "rest"))).alias("token"))

    wanted = written(read.select(F.explode("tokens").alias("token")).distinct(), "rule-tokens")
    counts = written(
        held.select("token").join(sent_if_small(wanted), "token").groupBy("token").agg(F.count("*").alias("n")),
        "token-counts",
    )
    n = F.coalesce("n", F.lit(0))
    known = read.select("*", F.explode("tokens").alias("token")).join(counts, "token", "left")
    chosen = known.groupBy("kind", "verdict", "rule", "regex").agg(F.min(F.struct(n.alias("n"), "token")).alias("least"))
    kept = chosen.select("kind", "verdict", "rule", "regex", "least.token")

    # Less than PART tokens can hold more than that part of all: a list of fixed size.
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    hot = F.broadcast(
        counts.where(F.col("n") * PART > total).select("token", F.ceil(F.col("n") * PART / total).cast("int").alias("parts"))
    )
    parts = F.coalesce("parts", F.lit(1))
    index = written(
        kept.join(hot, "token", "left").select(
            *kept.columns, F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
        ),
        "rule-index",
    )
    dealt = held.join(hot, "token", "left").withColumn("part", F.pmod(F.xxhash64("row"), parts).cast("int"))
    candidates = dealt.join(sent_if_small(index), ["token", "part"])
    # Not a literal: each candidate brings the expression of its rule.
    address = F.concat("host", F.when(F.col("kind") == ADDRESS, F.col("path")).otherwise(F.col("rest")))
    fits = candidates.where(F.rlike(address, F.col("regex")))

    strength = F.struct(
        F.char_length("rule").alias("length"), (F.col("verdict") == ALLOW).alias("allows"), "rule", "verdict"
    )
    best = fits.groupBy("row").agg(
        F.max(F.when(F.col("kind") == ADDRESS, strength)).alias("by_address"),
        F.max(F.when(F.col("kind") == PATTERN, strength)).alias("by_pattern"),
    )
    return rows.join(best, "row", "left").select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("by_address.rule").alias("rule"),
        F.coalesce("by_address.verdict", "by_pattern.verdict", F.lit(default)).alias("verdict"),
        F.col("by_pattern.rule").alias("pattern"),
    )

"""URL filter: listed rules first, then empirical-Bayes host reputation.

Labelled outcomes of pages are counted per host, registered domain and suffix. The rate of bad pages of each level is
shrunk towards the level above it through a beta prior, whose strength is estimated from how much the groups of that
level differ. A url is blocked when the lower posterior bound of its host's rate of bad pages reaches a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.shared import written

# Of several verdicts the longest fitting rule decides.
Rule = tuple[str, str]


@dataclass(frozen=True)
class Settings:
    """Threshold of the lower bound, standard deviations below the mean, and limits of the prior's strength in pages.

    With a threshold of one half a host is blocked when it is all but certain that most of its pages are bad.
    """

    threshold: float = 0.5
    deviations: float = 1.645
    weakest: float = 1.0
    strongest: float = 1000.0


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: str = "url") -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` or for NULL."""
    return F.coalesce(ascii_lower(F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: str = "url") -> Column:
    """From the end of the host up to `?`, `#` or the end; empty without `://` or for NULL."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(host: Column) -> Column:
    """The host without user, port and trailing dots."""
    name = F.regexp_replace(F.substring_index(host, "@", -1), r"(?<![:\[]):[0-9]*$", "")
    return F.regexp_replace(name, r"\.+$", "")


def is_address(name: Column) -> Column:
    """Whether a name is an IPv4 address or a bracketed IPv6 address."""
    return name.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$") | name.startswith("[")


ADDRESS = "(address)"


def domains_of(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """The columns of a table of different hosts with the domain and suffix of each.

    The suffix of a name is its last label, or the longest entry of `suffixes` (column suffix, lower case) that ends it at
    a dot. An entry `*.x` stands for x with any one label before it, and `!y.x` says that y.x is no suffix although such
    an entry fits; it beats all others. The registered domain is the suffix and one label more, or the name itself if it
    has no more. An address is its own domain, and all addresses share one suffix.
    """
    name = F.col("name")
    named = hosts.withColumn("name", name_of(F.col("host")))
    labels = F.size(F.split(name, r"\."))
    if suffixes is None:
        counted = named.withColumn("length", F.lit(1))
    else:
        rule = F.col("suffix")
        rules = suffixes.where("suffix IS NOT NULL").select(
            F.regexp_replace(rule, r"^(\*\.|!)", "").alias("tail"),
            F.when(rule.startswith("*."), 1).when(rule.startswith("!"), -1).otherwise(0).alias("more"),
        ).distinct()
        parts = F.split(name, r"\.")
        tails = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(parts, -n, n), ".").alias("tail")))
        met = named.where(~is_address(name)).select("host", F.inline(tails)).join(rules, "tail")
        best = F.max(F.struct((F.col("more") == -1).alias("exception"), (F.col("n") + F.col("more")).alias("length"))).alias("best")
        counted = named.join(met.groupBy("host").agg(best), "host", "left").withColumn("length", F.coalesce("best.length", F.lit(1)))
    length = F.least(F.greatest(F.col("length"), F.lit(1)), labels)
    tail = lambda n: F.when(n >= labels, name).otherwise(F.array_join(F.slice(F.split(name, r"\."), -n, n), "."))
    return counted.select(
        *hosts.columns, F.when(is_address(name), name).otherwise(tail(length + 1)).alias("domain"),
        F.when(is_address(name), F.lit(ADDRESS)).otherwise(tail(length)).alias("suffix"),
    )


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule `host/path` that fits: its host or a subdomain of it, and a path that starts with its path.

    Rules of equal length are tried in alphabetical order. The list is part of the expression, one test per rule.
    """
    fitting = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        fitting = F.when(fits, F.lit(rule)).otherwise(fitting)
    return fitting


def document_of(url: str = "url") -> Column:
    """The whole number that ends the path, with or without `.html` or a slash after it; NULL without one."""
    return F.regexp_extract(path_of(url), r"/([0-9]+)(?:\.html)?/?$", 1).try_cast("long")


def _opening(text: Column, words: int = 3) -> Column:
    """The first words with single spaces, however much white space comes before them; empty without a word."""
    first = F.regexp_extract(text, rf"^\s*(\S+(?:\s+\S+){{0,{words - 1}}})", 1)
    return F.regexp_replace(first, r"\s+", " ")


def title_of(html: str = "html") -> Column:
    """The page's title with the entities of markup characters resolved; empty without one."""
    title = F.coalesce(F.regexp_extract(F.col(html), r"<title>([^<]*)", 1), F.lit(""))
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        title = F.replace(title, F.lit(entity), F.lit(character))
    return title


def outcomes_of(pages: DataFrame, documents: DataFrame, judged: DataFrame) -> DataFrame:
    """(page_id, bad) of the pages that show a judged document; `judged` has doc_id and bad.

    The number in the url names the document, and the page's title must open like its text; a page whose number is of no
    document, or of one that opens differently, has no outcome, nor has one with a NULL url or html. Page ids are not
    document ids. Repeated rows of a page count each, those of a document or judgement once; no rows give no rows.
    """
    # Cut before the join, so no text is shuffled.
    known = documents.select("doc_id", _opening(F.col("text")).alias("opening")).join(judged, "doc_id").distinct()
    shown = pages.select("page_id", document_of().alias("doc_id"), _opening(title_of()).alias("title")).where("doc_id IS NOT NULL AND title <> ''")
    # A title is the first line, which can be shorter than the opening.
    opens = F.concat("opening", F.lit(" ")).startswith(F.concat("title", F.lit(" ")))
    return shown.join(known, "doc_id").where(opens).select("page_id", "bad")


def reputations(pages: DataFrame, outcomes: DataFrame, settings: Settings = Settings(), suffixes: DataFrame | None = None) -> DataFrame:
    """(host, domain, suffix, labelled, bad, mean, bound) per host of `pages`.

    `outcomes` has page_id and bad (0/1); pages without outcome and NULL outcomes count as unlabelled, and an id that
    occurs several times on either side counts once per page row, with its worst outcome. mean and bound are the
    posterior mean of the host's rate of bad pages and its lower bound. Without any outcome the rate is one half, with
    the weight of the weakest prior. `suffixes` is the table of `domains_of`.
    """
    worst = outcomes.where("bad IN (0, 1)").groupBy("page_id").agg(F.max("bad").alias("bad"))
    host = host_of()
    # Counted per host before anything else: a host holding a third of all pages is one row per task from here on.
    counted = pages.select("page_id", host.alias("host")).join(worst, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    hosts = written(domains_of(counted if suffixes is None else written(counted, "host-counts"), suffixes), "hosts")
    # Each level is written once; the one below and its own moments read it.
    domains = written(hosts.groupBy("domain", "suffix").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")), "domains")
    ends = written(domains.groupBy("suffix").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")), "suffixes")
    half = F.lit(settings.weakest / 2)
    world = ends.agg(
        (half + F.coalesce(F.sum("bad"), F.lit(0))).alias("a"), (half + F.coalesce(F.sum(F.col("labelled") - F.col("bad")), F.lit(0))).alias("b")
    )
    top = written(_shrunk(ends.crossJoin(F.broadcast(world)), settings).select("suffix", "a", "b"), "suffix-posteriors")
    middle = written(_shrunk(domains.join(top, "suffix"), settings).select("domain", "a", "b"), "domain-posteriors")
    shrunk = _shrunk(hosts.join(middle, "domain"), settings)
    a, b = F.col("a"), F.col("b")
    mean = a / (a + b)
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return shrunk.select(
        "host", "domain", "suffix", "labelled", "bad", mean.alias("mean"),
        F.greatest(F.lit(0.0), mean - settings.deviations * deviation).alias("bound"),
    )


def _shrunk(groups: DataFrame, settings: Settings) -> DataFrame:
    """The groups with (a, b) of their beta posteriors in place of those of their parents.

    A group's prior is its parent's posterior without the group's own pages, so none counts twice; it weighs as many
    pages as groups of the level resemble each other, but never more than the parent's evidence. The spread of
    beta-binomial counts k of n around a mean m is n m (1 - m) (1 + (n - 1) r); the common r of a level is found by
    moments over its groups, and 1 / r - 1 is the strength in pages.
    """
    n, k = F.col("labelled").cast("double"), F.col("bad").cast("double")
    others = F.col("a") + F.col("b") - n
    placed = groups.withColumn("others", others).withColumn("prior", (F.col("a") - k) / others)
    m = F.col("prior")
    plain = n * m * (1 - m)
    moments = placed.agg(
        F.sum((k - n * m) * (k - n * m) - plain).alias("excess"), F.sum((n - 1) * plain).alias("scale")
    ).select(
        F.greatest(
            F.lit(settings.weakest),
            F.least(
                F.lit(settings.strongest),
                F.when((F.col("scale") > 0) & (F.col("excess") > 0), F.col("scale") / F.col("excess") - 1).when(
                    F.col("scale") > 0, F.lit(settings.strongest)
                ).otherwise(F.lit(settings.weakest)),
            ),
        ).alias("level")
    )
    strength = F.least(F.col("level"), F.col("others"))
    joined = placed.crossJoin(F.broadcast(moments)).withColumn("strength", strength)
    return joined.withColumn("a", F.col("strength") * m + k).withColumn("b", F.col("strength") * (1 - m) + n - k)


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], settings: Settings = Settings(), suffixes: DataFrame | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mean, bound) for every row of `pages`.

    `rules` are (allow or block, host/path). Where none fits, the verdict is block if the host's lower bound reaches the
    threshold, else allow; urls that are NULL or have no host share the empty host. Repeated rows are judged alike and
    columns other than page_id and url are not read.
    """
    # One row per host of these pages, so every page finds its host.
    known = reputations(pages, outcomes, settings, suffixes).select("host", "mean", "bound")
    rows = pages.select("page_id", host_of().alias("host"), path_of().alias("path")).withColumn(
        "rule", rule_of(F.col("host"), F.col("path"), rules)
    )
    listed = F.lit(None).cast("string")
    for verdict, rule in rules:
        listed = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(listed)
    own = F.when(F.col("bound") >= settings.threshold, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(known, "host").select("page_id", "host", "path", "rule", F.coalesce(listed, own).alias("verdict"), "mean", "bound")

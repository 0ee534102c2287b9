"""URL filters: host and path rules, then a tree of path templates per host.

Paths become templates: numbers, hexadecimal keys and other segments with
digits are generalised by their form, and so are all children of a node that
has more than ``max_children`` different ones, at every depth.  Sibling
branches whose children look alike and whose labelled shares do not differ
significantly are merged; all siblings of a node are compared.  A template is rejected when the smoothed share of bad urls among its
labelled ones reaches ``reject_at``.

The tree is built from url templates that are counted first, so a host with
a third of all pages weighs as much as the templates it has.  All steps are
built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from playlens.llm.common import cut_lineage, digest128, free_names, lower_ascii

# The rules of the contract.
RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]

_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
# Forms of variable segments, tried in this order (a segment's extension stays).
_FORMS = [
    ("[0-9]+", "{num}"),
    ("(?=[a-f]*[0-9])[0-9a-f]{8,}(?:-[0-9a-f]{4,})*", "{hex}"),
    ("[^/.]*[0-9][^/.]*", "{id}"),
]
# Words of a host's names that mark its pages as bad.
HOST_WORDS = ("ads", "adult", "bets", "casino", "pills", "porn", "spam")


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def marked_host(host: Column, words: tuple[str, ...] = HOST_WORDS) -> Column:
    """Whether one of the words stands in the host between dots, hyphens and its ends."""
    return host.rlike(f"(?:^|[.-])(?:{'|'.join(words)})(?:[.-]|$)")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    names, verdicts = [], []
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        names.append(F.when(fits, F.lit(rule)))
        verdicts.append(F.when(fits, F.lit(verdict)))
    none = F.lit(None).cast("string")
    return F.coalesce(*names, none), F.coalesce(*verdicts, none)


def typed_path(path: Column) -> Column:
    """The path with variable segments replaced by their form, without a trailing slash."""
    out = F.regexp_replace(lower_ascii(path), "/+", "/")
    for form, name in _FORMS:
        out = F.regexp_replace(out, f"(?<=/){form}(?=(?:\\.[a-z]+)?(?:/|$))", name)
    return F.regexp_replace(out, "^/|/$", "")


def _steps(paths: DataFrame, path_col: str, *carried: str) -> DataFrame:
    """One row per path and segment: ``host``, the path's key (``k1``, ``k2``), ``depth``, ``seg`` and ``carried``."""
    k1, k2 = digest128(F.col(path_col))
    return paths.select(
        "host", k1.alias("k1"), k2.alias("k2"), *carried, F.posexplode(F.split(path_col, "/", -1)).alias("depth", "seg")
    )


def _along(rows: tuple[int, int] | None = None) -> WindowSpec:
    path = Window.partitionBy("host", "k1", "k2").orderBy("depth")
    return path.rowsBetween(*rows) if rows else path


def _with_parent(steps: DataFrame) -> DataFrame:
    """``steps`` with ``parent``: a hash of all segments above, so that a long path takes room in proportion."""
    above = F.bit_xor(F.xxhash64("depth", "seg")).over(_along((Window.unboundedPreceding, -1)))
    return steps.withColumn("parent", F.coalesce(above, F.lit(0).cast("long")))


def _paths(steps: DataFrame, name: str) -> DataFrame:
    """The paths' segments, joined again: (``host``, ``k1``, ``k2``, ``name``)."""
    segs = F.transform(F.sort_array(F.collect_list(F.struct("depth", "seg"))), lambda x: x["seg"])
    return steps.groupBy("host", "k1", "k2").agg(F.array_join(segs, "/").alias(name))


def _generalised(steps: DataFrame, max_children: int) -> DataFrame:
    """``steps`` with wildcards for all children of a node that has a wildcard or more than ``max_children`` children.

    A wildcard makes one node of many, whose children are then counted
    together: the rounds go on until no node is crowded.  Wildcards only
    spread, so this ends, and where it ends is what going down from the roots
    level by level gives; paths of any depth take as many rounds as they have
    wildcards that call for each other.
    """
    node = ["host", "depth", "parent"]
    while True:
        steps = cut_lineage(_with_parent(steps))
        children = steps.groupBy(*node, "seg").agg(F.lit(1).alias("one"))
        size = children.groupBy(*node).agg(F.count("one").alias("k"), F.bool_or(F.col("seg") == "*").alias("wild"))
        crowded = size.where((F.col("k") > max_children) | (F.col("wild") & (F.col("k") > 1))).select(*node, F.lit("*").alias("star"))
        crowded = cut_lineage(crowded)
        if crowded.isEmpty():
            return steps
        steps = steps.join(crowded, node, "left").withColumn("seg", F.coalesce("star", "seg")).drop("star", "parent")


def _similar(x: Column, y: Column, alike: float, z_limit: float) -> Column:
    """Whether what lies below two branches looks alike and their labels don't differ significantly."""
    def share(of: Column, kind: Column) -> Column:
        at = F.array_position(of["kinds"], kind).cast("int") - 1
        return F.coalesce(F.get(of["counts"], at), F.lit(0)) / of["n"]

    gap = F.aggregate(F.array_union(x["kinds"], y["kinds"]), F.lit(0.0), lambda s, k: s + F.abs(share(x, k) - share(y, k)) / 2)
    one = F.lit(1.0)
    pooled = F.try_divide(x["bad"] + y["bad"], x["labelled"] + y["labelled"])
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(one, x["labelled"]) + F.try_divide(one, y["labelled"])))
    apart = F.abs(F.try_divide(x["bad"], x["labelled"]) - F.try_divide(y["bad"], y["labelled"]))
    both = (x["labelled"] > 0) & (y["labelled"] > 0)
    none = (x["labelled"] == 0) & (y["labelled"] == 0)
    return (gap <= alike) & (none | F.when(both, apart <= z_limit * error).otherwise(F.lit(False)))


def _merged_names(nodes: DataFrame, max_children: int, alike: float, z_limit: float) -> DataFrame:
    """(``host``, ``depth``, ``parent``, ``seg``, ``name``): every branch under the name of the first that it merges with.

    All branches of a node are compared with each other, ``max_children`` at
    most; branches merge through others that are similar to both.
    """
    kids = F.sort_array(F.collect_list(F.struct("seg", "kinds", "counts", "n", "labelled", "bad")))
    family = nodes.groupBy("host", "depth", "parent").agg(kids.alias("kids"))
    places = F.sequence(F.lit(0), F.size("kids") - 1)

    def beside(i: Column) -> Column:
        first = lambda j: F.get("kids", F.least(i, j))
        second = lambda j: F.get("kids", F.greatest(i, j))
        return F.filter(places, lambda j: (i == j) | _similar(first(j), second(j), alike, z_limit))

    family = family.withColumn("near", F.transform(places, beside))
    rounds = F.sequence(F.lit(1), F.lit(max(max_children, 2).bit_length()))
    reach = F.aggregate(
        rounds, F.col("near"), lambda r, _: F.transform(r, lambda js: F.array_distinct(F.flatten(F.transform(js, lambda j: F.get(r, j)))))
    )
    family = family.withColumn("reach", reach)
    names = F.transform("kids", lambda kid, i: F.struct(kid["seg"].alias("seg"), F.get("kids", F.array_min(F.get("reach", i)))["seg"].alias("name")))
    return family.select("host", "depth", "parent", F.inline(names))


def path_templates(
    urls: DataFrame,
    max_children: int = 16,
    alike: float = 0.2,
    z_limit: float = 1.96,
    prior: float = 0.2,
    prior_weight: float = 4.0,
) -> DataFrame:
    """(``host``, ``typed``, ``template``, ``purity``) from ``urls`` (``host``, ``typed``, ``bad`` 1, 0 or null).

    ``purity`` is the share of bad urls among the labelled ones of the
    merged template, smoothed by ``prior_weight`` labels of share ``prior``.
    """
    sums = ["n", "labelled", "bad"]
    counted = cut_lineage(
        urls.groupBy("host", "typed").agg(
            F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
        )
    )
    k1, k2 = digest128(F.col("typed"))
    general = _paths(_generalised(_steps(counted, "typed"), max_children), "gen")
    known = cut_lineage(counted.withColumns({"k1": k1, "k2": k2}).join(general, ["host", "k1", "k2"]).drop("k1", "k2"))

    # Paths that are alike now are one path: a host's templates are few, however many urls it has.
    paths = known.groupBy("host", "gen").agg(*[F.sum(c).alias(c) for c in sums])
    steps = cut_lineage(_with_parent(_steps(paths, "gen", *sums)).withColumn("below", F.coalesce(F.lead("seg").over(_along()), F.lit(""))))
    kind = F.when(F.col("below").rlike("^(\\{|\\*|$)"), F.col("below")).otherwise("literal")
    node = ["host", "depth", "parent", "seg"]
    kinds = steps.groupBy(*node, kind.alias("kind")).agg(*[F.sum(c).alias(c) for c in sums])
    nodes = kinds.groupBy(*node).agg(
        F.sort_array(F.collect_list(F.struct("kind", F.col("n").alias("count")))).alias("looks"), *[F.sum(c).alias(c) for c in sums]
    )
    nodes = nodes.select(*node, F.col("looks.kind").alias("kinds"), F.col("looks.count").alias("counts"), *sums)
    names = _merged_names(nodes, max_children, alike, z_limit)
    renamed = steps.join(names, node).drop("seg").withColumnRenamed("name", "seg")
    k1, k2 = digest128(F.col("gen"))
    whole = paths.withColumns({"k1": k1, "k2": k2}).join(_paths(renamed, "merged"), ["host", "k1", "k2"])
    tree = cut_lineage(whole.select("host", "gen", F.concat(F.lit("/"), "merged").alias("template"), "labelled", "bad"))

    judged = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    purity = (F.col("bad") + prior * prior_weight) / (F.col("labelled") + prior_weight)
    rated = tree.select("host", "gen", "template").join(judged.select("host", "template", purity.alias("purity")), ["host", "template"])
    return known.select("host", "gen", "typed").join(rated, ["host", "gen"]).select("host", "typed", "template", "purity")


def url_filter(
    pages: DataFrame,
    url_col: str = "url",
    rules: list[tuple[str, str]] | None = None,
    bad: Column | None = None,
    reject_at: float = 0.8,
    **tree: float,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict`` (``allow`` or ``block``).

    ``rules`` are (verdict, host/path) pairs; the longest that fits decides.
    Else the url is blocked if its template's purity reaches ``reject_at``.
    ``bad`` marks labelled urls (1 bad, 0 good, null unknown); without it the
    verdicts of the rules are the labels, and beyond the rules the urls of
    marked hosts (``HOST_WORDS``) are labelled bad.

    Defined cases: a url of any length is read whole; a null url or one without ``://`` has an empty host and
    path, no rule, and the root template; an empty path fits no rule; urls
    without labels have the prior's purity; repeated rows are judged alike
    and count as often as they occur.  Input columns with the names of
    results are replaced; an empty table gives an empty result.
    """
    host, path, typed, label, name, verdict = free_names(pages, "_host", "_path", "_typed", "_label", "_rule", "_verdict")
    d = pages.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    found, said = rule_of(F.col(host), F.col(path), RULES if rules is None else rules)
    d = d.withColumns({typed: typed_path(F.col(path)), name: found, verdict: said})
    ruled = F.when(F.col(verdict) == "block", 1).when(F.col(verdict) == "allow", 0)
    known = bad if bad is not None else F.coalesce(ruled, F.when(marked_host(F.col(host)), 1))
    d = d.withColumn(label, known.cast("int"))
    urls = d.select(F.col(host).alias("host"), F.col(typed).alias("typed"), F.col(label).alias("bad"))
    templates = cut_lineage(path_templates(urls, **tree))
    thost, ttyped, tname, tpurity = free_names(d, "_thost", "_ttyped", "_template", "_purity")
    side = templates.select("host", "typed", "template", "purity").toDF(thost, ttyped, tname, tpurity)
    d = d.join(side, (F.col(host) == F.col(thost)) & (F.col(typed) == F.col(ttyped)), "left")
    method = F.when(F.col(tpurity) >= reject_at, "block").otherwise("allow")
    out = d.withColumns(
        {
            "host": F.col(host),
            "path": F.col(path),
            "rule": F.col(name),
            "template": F.col(tname),
            "purity": F.col(tpurity),
            "verdict": F.coalesce(F.col(verdict), method),
        }
    )
    return out.drop(host, path, typed, label, name, verdict, thost, ttyped, tname, tpurity)

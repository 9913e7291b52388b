"""Articles about code: frontmatter rules, mapping tables, and articles that changed code has left behind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the articles' schema, and words that say nothing about a path.
REQUIRED = ("title", "type", "area", "updated", "status")
ENUMS = {"type": ("concept", "connection", "meta"), "status": ("thin", "mature", "deprecated")}
STOP_WORDS = ("this", "that", "with", "when", "from", "into", "code")
ENDINGS = r"\.(py|ts|tsx|js|go|rs|rb|md|yml|yaml)$"


def glob_regex(pattern):
    """A path glob as a regular expression, by column functions: `**/` any folders or none, `**` anything, `*` and `?`
    within a folder's name. Placeholders keep the pieces apart while the rest is quoted."""
    got = F.regexp_replace(pattern, r"([.()\[\]{}+\\|^$])", r"\\$1")
    for glob, mark in (("**/", "\u0001"), ("**", "\u0002"), ("*", "\u0003"), ("?", "\u0004")):
        got = F.replace(got, F.lit(glob), F.lit(mark))
    for mark, regex in (("\u0001", "(?:.*/)?"), ("\u0002", ".*"), ("\u0003", "[^/]*"), ("\u0004", "[^/]")):
        got = F.replace(got, F.lit(mark), F.lit(regex))
    return F.concat(F.lit("^"), got, F.lit("$"))


def _plain(pattern):
    return F.regexp_replace(F.trim(pattern), "^`+|`+$", "")


def _like_path(plain):
    return F.contains(plain, F.lit("/")) | F.contains(plain, F.lit("*")) | plain.rlike(ENDINGS)


def _words(plain):
    return F.filter(F.regexp_extract_all(F.lower(plain), F.lit(r"(?U)(\w{4,})"), F.lit(1)), lambda w: ~w.isin(*STOP_WORDS))


def path_matches(pattern, path):
    """Whether a changed file's path matches a glob, or else has a word of a description in it."""
    plain = _plain(pattern)
    return F.when(_like_path(plain), F.regexp_like(path, glob_regex(plain))).otherwise(F.exists(_words(plain), lambda w: F.contains(F.lower(path), w)))


def matched_paths(patterns: DataFrame, paths: DataFrame) -> DataFrame:
    """code_pattern and path of each pattern and each path that it matches, once, as path_matches() has it.

    A glob meets only paths in the folder that it begins with, up to its first wildcard, and with the last three characters that it ends
    with, if it does; a description only paths with the first four characters of one of its words. Both are joins on equality. Defined
    results: null patterns and paths match nothing; repeated rows count once; a glob without any such folder or ending meets all paths."""
    asked = patterns.select("code_pattern").filter("code_pattern IS NOT NULL").distinct().withColumn("_plain", _plain("code_pattern"))
    files = paths.select("path").filter("path IS NOT NULL").distinct()
    ending = F.right(F.regexp_extract("_plain", r"([^*?/]*)$", 1), F.lit(3))
    globs = asked.filter(_like_path(F.col("_plain"))).select("code_pattern", "_plain", F.regexp_extract("_plain", r"^((?:[^*?/]*/)*)", 1).alias("_head"), F.when(F.length(ending) == 3, ending).otherwise("").alias("_ending"))
    parts = F.split("path", "/")
    heads = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))))
    keyed = files.select("path", F.explode(heads).alias("_head")).select("path", "_head", F.explode(F.array_distinct(F.array(F.lit(""), F.right("path", F.lit(3))))).alias("_ending"))
    by_glob = globs.join(keyed, ["_head", "_ending"]).filter(F.regexp_like("path", glob_regex(F.col("_plain")))).select("code_pattern", "path")
    words = asked.filter(~_like_path(F.col("_plain"))).select("code_pattern", F.explode(F.array_distinct(_words(F.col("_plain")))).alias("_word")).withColumn("_gram", F.left("_word", F.lit(4)))
    low = files.withColumn("_low", F.lower("path")).filter(F.length("_low") >= 4)
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_low") - 3), lambda i: F.substr("_low", i, F.lit(4))))
    by_word = words.join(low.select("path", "_low", F.explode(grams).alias("_gram")), "_gram").filter(F.contains("_low", "_word")).select("code_pattern", "path").distinct()
    return by_glob.unionByName(by_word)


def mapping_rows(texts: DataFrame, text: str = "value") -> DataFrame:
    """code_pattern and article_path of the rows of Markdown tables headed "When you change" and "Update this article"."""
    table = F.regexp_extract_all(F.col(text), F.lit(r"(?im)^.*when you change.*update this article.*\n((?:[ \t]*\|.*(?:\n|\z))*)"), F.lit(1))
    line = texts.select(F.explode(F.flatten(F.transform(table, lambda t: F.split(t, "\n")))).alias("line"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\|+|\|+$", ""), r"\|"), lambda c: F.trim(c))
    article = F.regexp_extract(F.try_element_at(cells, F.lit(2)), r"`([^`]+\.md)`", 1)
    return line.select(F.try_element_at(cells, F.lit(1)).alias("code_pattern"), article.alias("article_path")).filter("article_path <> ''")


def drift(mapping: DataFrame, changed: DataFrame, folder: str = "knowledge") -> DataFrame:
    """code_pattern, article_path and path of each changed file that a mapping row matches while its article did not change."""
    rooted = F.when(F.col("article_path").startswith(f"{folder}/") | F.col("article_path").startswith("/"), F.col("article_path")).otherwise(F.concat(F.lit(f"{folder}/"), "article_path"))
    rows = mapping.select("code_pattern", rooted.alias("article_path")).distinct()
    stale = rows.withColumn("path", F.regexp_replace("article_path", "^/+", "")).join(changed.select("path"), "path", "left_anti").drop("path")
    return stale.join(matched_paths(stale, changed), "code_pattern").select("code_pattern", "article_path", "path")


def frontmatter_errors(entries: DataFrame, articles: DataFrame) -> DataFrame:
    """path and error of broken rules. entries: path, key, values, as sources.storage.read_frontmatter gives; articles: the paths
    that references may name."""
    one = entries.withColumn("value", F.try_element_at("values", F.lit(1)))
    paths = entries.select("path").distinct()
    needed = paths.select("path", F.explode(F.array(*map(F.lit, REQUIRED))).alias("key"))
    missing = needed.join(one.filter("value IS NOT NULL"), ["path", "key"], "left_anti").select("path", F.concat(F.lit("missing "), "key").alias("error"))
    bad = None
    for key, allowed in ENUMS.items():
        rows = one.filter((F.col("key") == key) & ~F.col("value").isin(*allowed)).select("path", F.concat(F.lit(f"{key} is "), "value").alias("error"))
        bad = rows if bad is None else bad.unionByName(rows)
    dates = one.filter((F.col("key") == "updated") & ~F.col("value").rlike(r"^\d{4}-\d{2}-\d{2}$")).select("path", F.lit("updated is no date").alias("error"))
    flags = one.filter((F.col("key") == "load_bearing") & ~F.lower("value").isin("true", "false")).select("path", F.lit("load_bearing is no boolean").alias("error"))
    named = entries.filter("key = 'references'").select("path", F.explode("values").alias("ref"))
    form = named.filter("ref NOT LIKE '%.md'").select("path", F.concat(F.lit("reference is no article: "), "ref").alias("error"))
    dangling = named.filter("ref LIKE '%.md'").join(articles.select(F.col("path").alias("ref")), "ref", "left_anti").select("path", F.concat(F.lit("no such article: "), "ref").alias("error"))
    return missing.unionByName(bad).unionByName(dates).unionByName(flags).unionByName(form).unionByName(dangling)

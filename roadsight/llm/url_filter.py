"""URL filters: rules first, else logistic regression on hashed character
n-grams of host and path.  DataFrame functions and ``pyspark.ml`` only.

*Parts.*  The host runs from after the first ``://`` to the next /, ?, # or the
end, A-Z lower-cased; the path from there to ?, # or the end.  A null url, or
one without ``://``, has both empty.

*Rules.*  A rule is a host and a path beginning; it fits its host and all
subdomains of it where the path begins with the rule's.  The longest fitting
rule decides.

*Model.*  The labelled table is small: the caller's own (url, label 1 for
block), or at most ``max_rows`` urls that a rule decides, taken in hash order
from each verdict, so that the model learns what the rules say of the urls they
know and is asked about the rest.  Both labels weigh alike in training.  N-grams of
``GRAMS`` characters over ``^host$`` and ``^path$`` are counted into
``DIMENSIONS`` hashed features.

*Scale.*  Judging a page is a projection: no shuffle, and only the url column
is read.  Training gathers at most ``2 x max_rows`` urls.

Defined cases: a null url has empty parts, no rule and the model's verdict;
without labelled urls of both verdicts the only verdict seen stands for all
urls without a rule (allow if there is none); repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import read_table, stored

GRAMS = (3, 4)
DIMENSIONS = 1 << 12
MAX_ROWS = 5_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules in the order given (verdict, host, path beginning).
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    before = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^?#]*", 0)
    host = F.regexp_extract(before, r"(?s)^[^/]*", 0)
    path = F.substring(before, F.length(host) + F.lit(1), F.length(before))
    return F.translate(host, UPPER, LOWER), path


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):      # later, longer rules go on top
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def character_grams(host: Column, path: Column, sizes: tuple[int, ...] = GRAMS) -> Column:
    """All n-grams of ``^host$`` (tagged h) and ``^path$`` (tagged p)."""
    def grams(tag: str, part: Column, n: int) -> Column:
        marked = F.concat(F.lit("^"), part, F.lit("$"))
        chars = F.split(marked, "")
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - F.lit(n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(tag), F.array_join(F.slice(chars, i, n), "")))

    return F.concat(*[grams(tag, part, n) for tag, part in (("h", host), ("p", path)) for n in sizes])


def _featured(pages: DataFrame) -> DataFrame:
    """Adds ``features`` from the columns host and path."""
    grams = pages.withColumn("grams", character_grams(F.col("host"), F.col("path")))
    return HashingTF(numFeatures=DIMENSIONS, inputCol="grams", outputCol="features").transform(grams).drop("grams")


def labelled_urls(judged: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The small labelled table (host, path, label 1 for block): distinct
    parts that a rule decides, the first ``max_rows`` of each verdict in hash order."""
    known = judged.filter("rule_verdict is not null").select("host", "path", "rule_verdict").distinct()
    order = [F.xxhash64("host", "path"), "host", "path"]
    parts = [known.filter(F.col("rule_verdict") == v).orderBy(*order).limit(max_rows) for v in ("block", "allow")]
    return parts[0].unionByName(parts[1]).select("host", "path", (F.col("rule_verdict") == "block").cast("double").alias("label"))


def train(table: DataFrame) -> LogisticRegressionModel | None:
    """Logistic regression over the labelled table; None unless it has both labels."""
    n = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    if not n.get(0.0) or not n.get(1.0):
        return None
    weight = F.when(F.col("label") == 1, 0.5 / n[1.0]).otherwise(0.5 / n[0.0]) * (n[0.0] + n[1.0])
    learner = LogisticRegression(weightCol="weight", regParam=0.01, maxIter=50, standardization=False)
    return learner.fit(_featured(table.withColumn("weight", weight)))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES,
          max_rows: int = MAX_ROWS, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's block probability."""
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"))
    host, path = url_parts(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path).drop("url")
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = rows.withColumn("rule", name).withColumn("rule_verdict", verdict)
    if labelled is None:
        table = labelled_urls(judged, max_rows)
    else:
        own_host, own_path = url_parts(F.col("url"))
        table = labelled.select(own_host.alias("host"), own_path.alias("path"), F.col("label").cast("double").alias("label"))
    table = stored(table, "labelled-urls")
    model = train(table)
    if model is None:
        only = table.agg(F.max("label")).first()[0]
        scored = judged.withColumn("block_probability", F.lit(float(only or 0.0)))
    else:
        scored = model.transform(_featured(judged)).withColumn("block_probability", vector_to_array("probability")[1])
    by_model = F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_model).alias("verdict"), "block_probability")


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    """Query: page_id, host, path, rule, verdict for every page."""
    return judge(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")

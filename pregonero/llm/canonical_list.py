"""Problem 5: free-entered values -> the entry of a reference list that was meant, or none.

Token-level repair: every distinct token of the values is joined to the vocabulary of the list by edit distance
(through shared deletions, an equi-join) and by abbreviation; the repaired tokens then rank whole entries by soft
TF-IDF. Values are matched once per distinct spelling and joined back. No join is hinted: adaptive execution
broadcasts a side by its measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pregonero.functions.text import deletes, edit_distance, normalise_uf, words
from pregonero.session import cut

# Particles that carry no meaning of their own in place names.
PARTICLES = ["de", "do", "da", "dos", "das", "e"]
#: Letters and pairs that sound alike, folded to one before tokens are compared a second time.
SOUNDS = (("ch", "x"), ("qu", "k"), ("ss", "s"), ("z", "s"), ("c", "s"), ("ph", "f"), ("y", "i"), ("w", "v"), ("h", ""))
#: Least score of an entry that counts as meant.
ACCEPT = 0.5


def sound(token: Column) -> Column:
    for a, b in SOUNDS:
        token = F.replace(token, F.lit(a), F.lit(b))
    return F.regexp_replace(token, r"(.)\1", "$1")


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(words(text), " "), lambda t: (t != "") & ~t.isin(PARTICLES)))


def reference_index(reference: DataFrame, code: str, names: list[str], region: str) -> tuple[DataFrame, DataFrame]:
    """(entries: entry, code, region, norm, whole name; postings: token, entry, weight) of all names of the list."""
    rows = reference.select(F.col(code).alias("code"), F.col(region).alias("region"), F.explode(F.array(*names)).alias("name"))
    rows = rows.where(F.col("name").isNotNull()).dropDuplicates(["code", "name"]).withColumn("entry", F.xxhash64("code", "name"))
    rows = rows.withColumn("ts", tokens(F.col("name"))).where(F.size("ts") > 0)
    posts = rows.select("entry", F.explode("ts").alias("token"))
    n = rows.select("entry").distinct().agg(F.count("*").cast("double").alias("n_entries"))
    idf = posts.groupBy("token").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n)).withColumn("w", F.ln(F.col("n_entries") / F.col("df")) + 0.5).drop("n_entries")
    posts = posts.join(idf, "token")
    norm = posts.groupBy("entry").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return rows.join(norm, "entry").select("entry", "code", "region", "norm"), posts.select("token", "entry", "w", "df")


def repair_tokens(found: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(q, token, sim): the tokens of the vocabulary that the distinct token q may stand for.

    vocabulary: (token, df). Equal 1; edit distance 1, or 2 from six letters, by share of letters; equal sound 0.92;
    a piece of at most three letters, in order and from the first, of a token that occurs in two names or more 0.9.
    """
    keys = lambda t: F.explode(F.when(F.length(t) >= 6, deletes(t, 2)).when(F.length(t) >= 3, deletes(t, 1)).otherwise(F.array(t)))
    voc = vocabulary.select("token", keys(F.col("token")).alias("k"))
    d = edit_distance(F.col("q"), F.col("token"))
    longest = F.greatest(F.length("q"), F.length("token"))
    near = (
        found.select("q", keys(F.col("q")).alias("k")).join(voc, "k").select("q", "token").distinct()
        .withColumn("d", d).where((F.col("d") <= 1) | ((F.col("d") == 2) & (longest >= 6)))
        .select("q", "token", (1 - F.col("d") / (longest * 1.5)).alias("sim"))
    )
    alike = found.select("q", sound(F.col("q")).alias("s")).join(vocabulary.select("token", sound(F.col("token")).alias("s")), "s").select("q", "token", F.lit(0.92).alias("sim"))
    # every beginning-and-part of up to three letters of the frequent tokens; they are of the reference list, not of the rows
    letters = F.sequence(F.lit(2), F.length("token"))
    frequent = vocabulary.where((F.col("df") >= 2) & (F.length("token") > 2))
    at = lambda i: F.substring(F.col("token"), i, F.lit(1))
    head = F.substring("token", 1, 1)
    parts = F.flatten(F.transform(letters, lambda i: F.concat(
        F.array(F.concat(head, at(i))),
        F.transform(F.filter(letters, lambda j: j > i), lambda j: F.concat(head, at(i), at(j))),
    )))
    short = frequent.select("token", F.explode(F.array_distinct(F.concat(F.array(head), parts))).alias("q"))
    brief = found.where(F.length("q") <= 3).join(short, "q").where(F.col("q") != F.col("token")).select("q", "token", F.lit(0.9).alias("sim"))
    return near.unionByName(alike).unionByName(brief).groupBy("q", "token").agg(F.max("sim").alias("sim"))


def match_to_list(values: DataFrame, reference: DataFrame, code: str, names: list[str], region: str, size: str | None = None) -> DataFrame:
    """values: distinct (text, want) -> (text, want, code, score) of the best entry; none if no token is known.

    An entry of another region than `want` counts 15 % less; a null `want` takes no side. Equal scores go to the
    larger `size` of the reference, then to the smaller code. Text without a token gives no row.
    """
    entries, posts = reference_index(reference, code, names, region)
    posts = cut(posts)
    told = cut(values.select("text", "want", F.explode(tokens(F.col("text"))).alias("q")))
    vocabulary = posts.groupBy("token").agg(F.first("df").alias("df"), F.max("w").alias("tw"))
    strongest = float(posts.agg(F.max("w")).first()[0] or 1.0)
    fixed = cut(repair_tokens(told.select("q").distinct(), vocabulary).join(vocabulary, "token"))
    # a token of the value weighs as its best and most common repair, an unknown one as the rarest, a slip of a particle nothing
    own = fixed.groupBy("q").agg(F.max_by("tw", F.struct(F.col("sim"), -F.col("tw"))).alias("qw"))
    slip = F.length("q").between(2, 4) & (F.least(*[F.levenshtein(F.col("q"), F.lit(p)) for p in PARTICLES if len(p) > 1]) <= 1)
    query = told.join(own, "q", "left").withColumn("qw", F.coalesce("qw", F.when(slip, 0.0).otherwise(strongest)))
    qnorm = query.groupBy("text", "want").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
    hits = (
        query.join(fixed.select("q", "token", "sim"), "q").join(posts.select("token", "entry", "w"), "token")
        # every token of the entry takes its best token of the value, which then counts for one token only
        .groupBy("text", "want", "entry", "token").agg(F.max(F.struct("sim", (F.col("qw") * F.col("w") * F.col("sim")).alias("part"), "q")).alias("x"))
        .groupBy("text", "want", "entry", "x.q").agg(F.max("x.part").alias("part"))
        .groupBy("text", "want", "entry").agg(F.sum("part").alias("dot"))
    )
    weight = F.col(size).cast("double") if size else F.lit(0.0)
    sizes = reference.groupBy(F.col(code).alias("code")).agg(F.max(weight).alias("size"))
    entries = entries.join(sizes, "code").withColumnRenamed("region", "of")
    qnorm = qnorm.withColumnsRenamed({"text": "__t", "want": "__w"})
    scored = hits.join(entries, "entry").join(qnorm, (F.col("text") == F.col("__t")) & F.col("want").eqNullSafe(F.col("__w")))
    cosine = F.least(F.lit(1.0), F.col("dot") / (F.col("norm") * F.greatest("qnorm", F.lit(1e-9))))
    score = F.round(cosine * F.when(F.col("want") != F.col("of"), 0.85).otherwise(1.0), 6)
    best = F.min(F.struct((-score).alias("score"), (-F.coalesce("size", F.lit(0.0))).alias("size"), F.col("code").alias("code"))).alias("b")
    return scored.groupBy("text", "want").agg(best).select("text", "want", "b.code", (-F.col("b.score")).alias("score"))


STATE_END = r"(?i)\s*(?:[-/,]|\(|\s)\s*\(?([a-z]\.?[a-z])\.?\)?\s*$"
HEAD = r"(?i)^\s*(?:munic[ií]pio\s+d[eoa]\s+|munic?\.\s*(?:d[eoa]\s+)?|comarca\s+d[eoa]\s+|cidade\s*(?:d[eoa]\s+|:)\s*)"
RAW_STATE = r"(?i)(?:/|\(|\s-|,)\s*([a-z]{2})\)?\s*(?:$|,|/|-\s*cep)"


def split_place(name: Column, uf: Column) -> tuple[Column, Column]:
    """(clean name, state): heads such as `Municipio de` and a state at the end of the name are taken off; the state
    column wins over that in the name."""
    clean = F.regexp_replace(F.trim(name), HEAD, "")
    end = F.regexp_extract(clean, STATE_END, 1)
    said = F.when(F.length(clean) > F.length(end) + 2, normalise_uf(end))
    clean = F.when(said.isNotNull() & clean.rlike(r"[-/,(]\s*\(?[A-Za-z]\.?[A-Za-z]\.?\)?\s*$"), F.regexp_replace(clean, STATE_END, "")).otherwise(clean)
    said = F.when(clean != F.regexp_replace(F.trim(name), HEAD, ""), said)
    return words(clean), F.coalesce(normalise_uf(uf), said)


def municipalities(addresses: DataFrame, reference: DataFrame) -> DataFrame:
    """(address_id, municipality_code): for each address with a non-blank name and without a valid code, the code
    meant or `none`. An address repeated under one id comes out once per distinct result."""
    codes = (reference.select(F.col("ibge_code").alias("municipality_code")).distinct())
    name, uf = split_place(F.col("municipality_name"), F.col("uf"))
    # a state that only the whole text names decides between namesakes
    uf = F.coalesce(uf, normalise_uf(F.regexp_extract("raw_text", RAW_STATE, 1)))
    rest = addresses.where(F.trim(F.regexp_replace("municipality_name", r"\s+", " ")) != "").join(codes, "municipality_code", "left_anti")
    rest = rest.select(F.col("id").alias("address_id"), name.alias("text"), uf.alias("want"))
    found = match_to_list(rest.select("text", "want").distinct(), reference, "ibge_code", ["name", "alt_name"], "uf", "population_last")
    found = found.withColumnsRenamed({"text": "__t", "want": "__w"})
    joined = rest.join(found, (F.col("text") == F.col("__t")) & F.col("want").eqNullSafe(F.col("__w")), "left")
    return joined.select("address_id", F.when(F.col("score") >= ACCEPT, F.col("code")).otherwise("none").alias("municipality_code"), "text", "want", "score").distinct()

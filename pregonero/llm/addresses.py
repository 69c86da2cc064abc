"""Problem 4: address records that denote the same location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pregonero.functions.text import deletes, edit_distance, fold, words
from pregonero.functions.timestamps import barrier
from pregonero.llm.canonical_list import municipalities
from pregonero.llm.components import hash_to_min
from pregonero.session import cut

CEP = r"(?<!\d)(\d{2}\.?\d{3}-?\d{3})(?!\d)"
_FLAT = r"(?:apartamento|apart|apto|apt|ap|unidade|unid|conjunto no|sala)\.?\s*(?:n[o.]\s*)?"
_TOWER = r"(?:bloco|torre|bl|tr)\.?\s*"
#: Units on folded text: number before or after the tower, number with a letter, number alone.
UNITS = (
    rf"\b{_TOWER}(?<b1>[a-z])\b[\s,/-]*{_FLAT}(?<a1>\d{{1,6}})\b",
    rf"\b{_FLAT}(?<a2>\d{{1,6}})\s*[,/-]?\s*{_TOWER}(?<b2>[a-z])\b",
    rf"\b{_FLAT}(?<a3>\d{{1,6}})\s*-?\s*(?<b3>[a-z])\b(?![.'])",
    rf"\b{_FLAT}(?<a4>\d{{1,6}})\b",
    r"(?<![\d#])\b(?<a5>\d{2,6})-?(?<b5>[a-z])\b",
)
UNIT = "(?:" + "|".join(UNITS) + ")"
NOT_UNITS = r"\b(?:imovel residencial|terreo|c/ ?garagem|casa|fundos e frente|sobrado)\b"
NUMBER = r"(?:\bn[o.]?\s*|\bnum\.?\s*|#\s*|\bnumero\s*)?"
#: On the text without postal code and unit: the street is what stands before the first number.
STREET = r"(?:^|[,:;()/]|\s-\s|\bsituado a\b|-(?=\s))\s*(?<s>[a-z][^,:;()/0-9#]*?)[\s,-]*" + NUMBER + r"\b(?<n>\d{1,7})\b"
def ordinals(text: Column) -> Column:
    """Folded, with the signs of numbers (nº, n°) as `no`."""
    return F.regexp_replace(fold(text), "[º°]", "o")


def parse_addresses(rows: DataFrame) -> DataFrame:
    """Add a_cep, a_flat, a_tower, a_number, a_street (folded words with the kind), a_raw (folded rest of the text).

    The parts win over raw_text; each is read wherever it stands, as parts stand in wrong fields. Missing is null.
    """
    keep = rows.columns
    parts = F.concat_ws(", ", F.concat_ws(" ", F.nullif(F.trim("street_type"), F.lit("")), "street_name"), "number", "complement")
    step = barrier(rows, keep, {"__p": ordinals(parts), "__r": ordinals(F.coalesce(F.col("raw_text"), F.lit("")))})
    cep = F.coalesce(F.nullif(F.regexp_extract(F.coalesce("cep", F.lit("")), CEP, 1), F.lit("")), F.nullif(F.regexp_extract("__r", CEP, 1), F.lit("")))
    bare = lambda c: F.regexp_replace(F.regexp_replace(F.col(c), r"(?:\bcep\s*:?\s*)?" + CEP, " , "), NOT_UNITS, " , ")
    step = barrier(step, keep, {"a_cep": F.regexp_replace(cep, r"\D", ""), "__p": bare("__p"), "__r": bare("__r")})
    group = "${a1}${a2}${a3}${a4}${a5}|${b1}${b2}${b3}${b5}"
    unit = lambda c: F.regexp_replace(F.regexp_extract(F.col(c), UNIT, 0), "^" + UNIT + "$", group)
    gone = lambda c: F.regexp_replace(F.col(c), UNIT, " , ")
    step = barrier(step, [*keep, "a_cep"], {"__u": F.coalesce(F.nullif(unit("__p"), F.lit("")), F.nullif(unit("__r"), F.lit(""))), "__p": gone("__p"), "__r": gone("__r")})
    found = lambda c: F.regexp_extract(F.col(c), STREET, 0)
    step = barrier(step, [*keep, "a_cep", "__u", "__p", "__r"], {"__ps": found("__p"), "__rs": found("__r")})
    street = lambda c: F.nullif(F.regexp_extract(F.col(c), STREET, 1), F.lit(""))
    number = lambda c: F.regexp_replace(F.nullif(F.regexp_extract(F.col(c), STREET, 2), F.lit("")), "^0+(?=.)", "")
    clean = lambda c: F.nullif(words(F.regexp_replace(c, r"^(?:endereco|imovel situado a|situado a|bairro)\b", " ")), F.lit(""))
    return barrier(step, [*keep, "a_cep"], {
        "a_flat": F.nullif(F.substring_index("__u", "|", 1), F.lit("")), "a_tower": F.nullif(F.substring_index("__u", "|", -1), F.lit("")),
        "a_number": F.coalesce(number("__ps"), number("__rs")), "a_street": F.coalesce(clean(street("__ps")), clean(street("__rs"))), "a_raw": F.col("__r"),
    })


# Full forms that open a street name. Their short and misspelt forms are mined, not listed.
KIND_WORDS = ["rua", "avenida", "travessa", "praca", "estrada", "alameda", "rodovia", "largo", "viela", "via"]
TITLE_WORDS = ["doutor", "coronel", "engenheiro", "professor", "padre", "major", "comendador", "dona", "capitao", "general", "santo", "santa"]
#: A rewrite is kept from this many groups of agreeing addresses on, at this log-likelihood ratio (p < 0.001).
LEAST_SUPPORT, LEAST_RATIO = 4, 10.83
ACCEPT_STREET = 0.66


def mine_rewrites(spellings: DataFrame, initials: bool = True) -> DataFrame:
    """(bad, good, support, g2): token pairs that stand for each other in spellings of one street.

    spellings: (place, street, n), distinct street texts of addresses that agree in `place` (postal code). Every
    spelling is aligned to the most frequent one of its place, so a place of any size gives one pair per spelling.
    The first token is marked with `^`: a single letter there may be a short form, as of a kind of street, unless
    initials is false. A pair is significant by
    the log-likelihood ratio of its count against the counts of its two tokens among all pairs.
    """
    tokens = F.split(F.concat(F.lit("^"), F.col("street")), " ")
    rows = spellings.withColumn("ts", tokens)
    top = rows.groupBy("place").agg(F.max_by("ts", F.struct("n", F.size("ts"), "street")).alias("rs"))
    both = rows.join(top, "place").where(F.col("ts") != F.col("rs")).select("place", F.array_except("ts", "rs").alias("a"), F.array_except("rs", "ts").alias("b"))
    pairs = both.where((F.size("a") == F.size("b")) & (F.size("a") <= 2)).select("place", F.inline(F.arrays_zip("a", "b")))
    pairs = pairs.where(F.col("a").startswith("^") == F.col("b").startswith("^"))
    # an initial stands for many names and is no rewrite
    brief = lambda t: (F.length(F.replace(F.col(t), F.lit("^"))) <= 1) & ~(F.col(t).startswith("^") & F.lit(initials))
    pairs = pairs.where(~brief("a") & ~brief("b")).distinct()
    # b is of the most frequent spelling; the evidence of both directions counts together, and the full form is the longer
    # token, or of two as long within a letter the one that was the frequent one more often
    x, y = F.least("a", "b"), F.greatest("a", "b")
    counts = pairs.groupBy(x.alias("x"), y.alias("y")).agg(F.count("*").alias("support"), F.count_if(F.col("b") == x).alias("x_good"))
    to_x = F.when(F.abs(F.length("x") - F.length("y")) > 1, F.length("x") > F.length("y")).otherwise(F.col("x_good") * 2 > F.col("support"))
    counts = counts.select(F.when(to_x, F.col("y")).otherwise(F.col("x")).alias("bad"), F.when(to_x, F.col("x")).otherwise(F.col("y")).alias("good"), "support")
    over = lambda c: F.sum("support").over(Window.partitionBy(c))
    counts = cut(counts.withColumn("nb", over("bad")).withColumn("ng", over("good")))
    total = float(counts.agg(F.sum("support")).first()[0] or 0)
    term = lambda o, e: F.when((o > 0) & (e > 0), o * F.ln(o / e)).otherwise(0.0)
    k, nb, ng = (F.col(c).cast("double") for c in ("support", "nb", "ng"))
    g2 = 2 * (
        term(k, nb * ng / total) + term(nb - k, nb * (total - ng) / total) + term(ng - k, (total - nb) * ng / total)
        + term(total - nb - ng + k, (total - nb) * (total - ng) / total)
    ) if total else F.lit(0.0)
    good = counts.withColumn("g2", g2).where((k >= LEAST_SUPPORT) & (F.col("g2") >= LEAST_RATIO) & (k >= 0.3 * nb))
    return good.groupBy("bad").agg(F.max_by(F.struct("good", "support", "g2"), F.struct("support", "good")).alias("x")).select("bad", "x.*")


def rewrite(streets: DataFrame, rewrites: DataFrame) -> DataFrame:
    """(street, to): distinct street texts with the rewrites applied to their tokens."""
    tokens = streets.select("street", F.posexplode(F.split(F.concat(F.lit("^"), F.col("street")), " ")).alias("i", "bad"))
    new = tokens.join(rewrites.select("bad", "good"), "bad", "left").groupBy("street").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("good", "bad").alias("t")))).alias("ts"))
    return new.select("street", F.replace(F.array_join(F.transform("ts", lambda x: x.t), " "), F.lit("^")).alias("to"))


def _fingerprint(norm: DataFrame) -> tuple[int, int]:
    """Two order-free sums that tell one set of (street, norm) from another."""
    h = F.xxhash64("street", "norm")
    r = norm.agg(F.coalesce(F.sum(F.shiftrightunsigned(h, 8).cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.bit_xor(h), F.lit(0))).first()
    return int(r[0]), int(r[1])


def normalise_streets(rows: DataFrame, place: str, street: str) -> tuple[DataFrame, DataFrame]:
    """(street, norm) of the distinct street texts, and the rewrites used, mined and applied round after round until
    there is none, or they lead back to texts of an earlier round. Rewrites only give tokens that exist, so one of both
    comes. Each round costs one pass over distinct texts, never over the rows."""
    texts = cut(rows.where(F.col(street).isNotNull()).groupBy(F.col(place).alias("place"), F.col(street).alias("street")).agg(F.count("*").alias("n")))
    norm = cut(texts.select("street").distinct().select("street", F.col("street").alias("norm")))
    used, seen = None, {_fingerprint(norm)}
    while True:
        now = texts.where(F.col("place").isNotNull()).join(norm, "street").groupBy("place", F.col("norm").alias("street")).agg(F.sum("n").alias("n"))
        mined = cut(mine_rewrites(now))
        if mined.isEmpty():
            break
        used = mined if used is None else used.unionByName(mined)
        step = rewrite(norm.select(F.col("norm").alias("street")).distinct(), mined).withColumnRenamed("street", "norm")
        norm = cut(norm.join(step, "norm").select("street", F.col("to").alias("norm")))
        state = _fingerprint(norm)
        if state in seen:
            break
        seen.add(state)
    return norm, used if used is not None else mined


def _known_word(token: Column, known: list[str]) -> Column:
    close = lambda w: (token == w) | ((F.length(token) >= 4) & (F.levenshtein(token, F.lit(w)) <= (2 if len(w) > 6 else 1)))
    return F.coalesce(*[F.when(close(w), w) for w in known])


def with_parts(streets: DataFrame, street: str) -> DataFrame:
    """Add kind, title and names of a normalised street text; each step is computed once."""
    keep = streets.columns
    step = barrier(streets, keep, {"__ts": F.split(F.col(street), " ")})
    step = barrier(step, [*keep, "__ts"], {"kind": F.when(F.size("__ts") > 2, _known_word(F.col("__ts")[0], KIND_WORDS))})
    step = barrier(step, [*keep, "kind"], {"__ts": F.when(F.col("kind").isNotNull(), F.slice("__ts", 2, F.size("__ts"))).otherwise(F.col("__ts"))})
    step = barrier(step, [*keep, "kind", "__ts"], {"title": F.when(F.size("__ts") > 2, _known_word(F.col("__ts")[0], TITLE_WORDS))})
    return barrier(step, [*keep, "kind", "title"], {"names": F.when(F.col("title").isNotNull(), F.slice("__ts", 2, F.size("__ts"))).otherwise(F.col("__ts"))})


def _token_similarity(x: Column, y: Column) -> Column:
    d = edit_distance(x, y)
    least = F.least(F.length(x), F.length(y))
    return (
        F.when(x == y, 1.0).when((least == 1) & (F.substring(x, 1, 1) == F.substring(y, 1, 1)), 0.75).when((d == 1) & (least >= 3), 0.9)
        .when((d == 2) & (least >= 5), 0.8).when((d == 3) & (least >= 8), 0.7).otherwise(0.0)
    )


def with_similarity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Add sim of two streets whose parts have the prefixes a and b: 0 if both kinds are known and differ; other titles
    cost 0.15. Of the names the shorter list must be found in the longer; tokens may be slips or initials, the last
    ones may not be initials; each token left over costs 0.08."""
    keep = [c for c in pairs.columns if c not in {f"{x}{n}" for x in (a, b) for n in ("kind", "title", "names")}]
    x, y = F.col(f"{a}names"), F.col(f"{b}names")
    differ = lambda n: F.col(f"{a}{n}").isNotNull() & F.col(f"{b}{n}").isNotNull() & (F.col(f"{a}{n}") != F.col(f"{b}{n}"))
    first = F.size(x) <= F.size(y)
    step = barrier(pairs.where(~differ("kind")), keep, {
        "__short": F.when(first, x).otherwise(y), "__long": F.when(first, y).otherwise(x), "__x": F.element_at(x, -1), "__y": F.element_at(y, -1),
        "__less": F.when(differ("title"), 0.15).otherwise(0.0) + F.abs(F.size(x) - F.size(y)) * 0.08,
    })
    step = step.where((F.length("__x") > 1) & (F.length("__y") > 1))
    best = F.transform("__short", lambda s: F.array_max(F.transform("__long", lambda t: _token_similarity(s, t))))
    step = barrier(step, [*keep, "__less"], {"__best": best, "__end": _token_similarity(F.col("__x"), F.col("__y"))})
    mean = F.aggregate("__best", F.lit(0.0), lambda s, v: s + v) / F.size("__best")
    return barrier(step, keep, {"sim": F.when((F.array_min("__best") > 0) & (F.col("__end") > 0.74), mean - F.col("__less")).otherwise(0.0)})


def _blocks(streets: DataFrame, id_col: str, out: str) -> DataFrame:
    """(key, single, out): hashed with the city, what two streets share that with_similarity can find alike: up to a slip the
    last name and the first letter of another one, or up to a slip another name and the first or last letter of the
    last one; where one of them has a single name, the last name. So a frequent name alone is no key of long names."""
    last = F.element_at("names", -1)
    rest = F.array_distinct(F.slice("names", 1, F.greatest(F.size("names") - 1, F.lit(0))))
    rows = streets.where((F.size("names") > 0) & (F.length(last) > 1))
    # pieces in columns of their own: a lambda would compute them again for every element
    keep = ["city", id_col, "__single"]
    rows = barrier(rows.withColumn("__single", F.size("names") == 1), keep, {
        "__last": deletes(last, 1), "__first": F.array_distinct(F.transform(rest, lambda t: F.substring(t, 1, 1))),
        "__rest": F.array_distinct(F.flatten(F.transform(F.filter(rest, lambda t: F.length(t) >= 3), lambda t: deletes(t, 1)))), "__ends": F.array(F.concat(F.substring(last, 1, 1), F.lit("-")), F.concat(F.lit("-"), F.right(last, F.lit(1)))),
    })
    both = lambda x, y, mark: F.flatten(F.transform(x, lambda k: F.transform(y, lambda e: F.concat(F.lit(mark), k, F.lit("|"), e))))
    pairs = rows.select("city", F.col(id_col).alias(out), F.lit(None).cast("boolean").alias("single"), F.explode(F.concat(both("__last", "__first", "a"), both("__rest", "__ends", "b"))).alias("k"))
    alone = rows.select("city", F.col(id_col).alias(out), F.col("__single").alias("single"), F.explode("__last").alias("k"))
    return pairs.unionByName(alone).select(F.xxhash64("city", "k").alias("key"), "single", out)


def _candidates(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct (a, b) of the blocks a and b that share a key; only hashes are shuffled. Of keys of the last name alone
    one side must be a single name."""
    one = b.withColumnRenamed("single", "other")
    return a.join(one, "key").where("single is null or single or other").select("a", "b").distinct()


NO_STREET, NO_NUMBER, NO_PLACE = "no street", "no number", "no city and no postal code"


def unlocated(rows: DataFrame) -> DataFrame:
    """(id, reason) of the rows of parse_addresses with `city` that can't denote a location."""
    why = F.when(F.col("a_street").isNull(), NO_STREET).when(F.col("a_number").isNull(), NO_NUMBER).when(F.col("a_cep").isNull() & F.col("city").isNull(), NO_PLACE)
    return rows.select("id", why.alias("reason")).where("reason is not null").distinct()


def locate(rows: DataFrame) -> DataFrame:
    """rows of parse_addresses with `city` -> id and `location`, equal for records of one location.

    A street is a postal code; a street text without one takes the code of the street of its city that it resembles
    most, with the house number, the unit and the district as further evidence between look-alikes; texts that
    resemble no such street are grouped among themselves. Rows without street, number or any of city and code have
    no location; unlocated tells why.
    """
    rows = cut(rows.where(F.col("a_street").isNotNull() & F.col("a_number").isNotNull()).select(
        "id", "city", "a_cep", "a_street", "a_number", F.coalesce("a_flat", F.lit("")).alias("flat"), F.coalesce("a_tower", F.lit("")).alias("tower"),
        words(F.concat_ws(" ", "district", "raw_text")).alias("around"), F.element_at(F.split(words(F.col("district")), " "), -1).alias("area"),
    ))
    norm, _ = normalise_streets(rows, "a_cep", "a_street")
    rows = cut(rows.join(norm.withColumnRenamed("street", "a_street"), "a_street"))
    coded, open_ = rows.where(F.col("a_cep").isNotNull()), rows.where(F.col("a_cep").isNull() & F.col("city").isNotNull())
    # the city of a code is what most of its rows say
    city_of = coded.where(F.col("city").isNotNull()).groupBy("a_cep").agg(F.mode("city", True).alias("city"))
    parts = ("kind", "title", "names")
    named = lambda df, x: [F.col(n).alias(f"{x}{n}") for n in parts]
    known = cut(with_parts(coded.select("a_cep", "norm").distinct().join(city_of, "a_cep"), "norm"))
    asked = cut(with_parts(open_.select("city", "norm").distinct(), "norm"))
    asked = asked.withColumn("qid", F.xxhash64("city", "norm"))
    known = known.withColumn("kid", F.xxhash64("a_cep", "norm"))
    pairs = _candidates(_blocks(asked, "qid", "a"), _blocks(known, "kid", "b"))
    pairs = pairs.join(asked.select(F.col("qid").alias("a"), "city", F.col("norm").alias("q"), *named(asked, "q_")), "a").join(known.select(F.col("kid").alias("b"), "a_cep", *named(known, "k_")), "b")
    near = with_similarity(pairs, "q_", "k_").groupBy("city", "q", "a_cep").agg(F.max("sim").alias("sim")).where(F.col("sim") >= ACCEPT_STREET)
    near = cut(near)
    # evidence of the row itself
    numbers = coded.select("a_cep", "a_number", F.lit(1).alias("has_number"), (F.col("flat") != "").alias("w"), (F.col("tower") != "").alias("x")).distinct()
    areas = coded.where(F.length("area") > 2).groupBy("a_cep").agg(F.mode("area", True).alias("of_area"))
    tried = open_.select("id", "city", F.col("norm").alias("q"), "a_number", (F.col("flat") != "").alias("w"), (F.col("tower") != "").alias("x"), "around").join(near, ["city", "q"])
    tried = tried.join(numbers, ["a_cep", "a_number", "w", "x"], "left").join(areas, "a_cep", "left")
    rank = F.col("sim") + F.coalesce(F.col("has_number"), F.lit(0)) * 0.25 + F.when(F.instr("around", F.col("of_area")) > 0, 0.1).otherwise(0.0)
    chosen = tried.groupBy("id").agg(F.max_by("a_cep", F.struct(F.round(rank, 6), "a_cep")).alias("code"))
    # the rest: texts of one city that resemble each other
    left = cut(open_.join(chosen, "id", "left_anti"))
    texts = cut(with_parts(left.select("city", "norm").distinct().withColumn("tid", F.xxhash64("city", "norm")), "norm"))
    couples = _candidates(_blocks(texts, "tid", "a"), _blocks(texts, "tid", "b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    couples = couples.join(texts.select(F.col("tid").alias("a"), *named(texts, "a_")), "a").join(texts.select(F.col("tid").alias("b"), *named(texts, "b_")), "b")
    links = with_similarity(couples, "a_", "b_").where(F.col("sim") >= ACCEPT_STREET + 0.1).select("a", "b")
    groups = hash_to_min(links, "a", "b")
    own = left.withColumn("tid", F.xxhash64("city", "norm")).join(groups.withColumnRenamed("id", "tid"), "tid", "left")
    street = lambda c: c.cast("string").alias("street")
    cols = ["id", "a_number", "flat", "tower"]
    out = (
        coded.select(*cols, street(F.col("a_cep")))
        .unionByName(open_.join(chosen, "id").select(*cols, street(F.col("code"))))
        .unionByName(own.select(*cols, street(F.concat(F.lit("t"), F.coalesce("group_id", "tid").cast("string")))))
    )
    return out.select("id", F.concat_ws("|", "street", "a_number", "flat", "tower").alias("location")).distinct()


def same_location_pairs(located: DataFrame) -> DataFrame:
    """(address_id_a, address_id_b), smaller first, of all records that share a location."""
    l, r = located.alias("l"), located.alias("r")
    pairs = l.join(r, F.col("l.location") == F.col("r.location")).where(F.col("l.id") < F.col("r.id"))
    return pairs.select(F.col("l.id").alias("address_id_a"), F.col("r.id").alias("address_id_b")).distinct()


def with_city(addresses: DataFrame, reference: DataFrame) -> DataFrame:
    """The parts of addresses with `city`: the valid code, else the entry that the free name means, else null. Other
    columns are left out, so none can clash."""
    addresses = addresses.select("id", "street_type", "street_name", "number", "complement", "district", "municipality_name", "municipality_code", "uf", "cep", "raw_text")
    codes = reference.select(F.col("ibge_code").alias("__code")).distinct()
    meant = municipalities(addresses, reference).where(F.col("municipality_code") != "none").groupBy(F.col("address_id").alias("id")).agg(F.min("municipality_code").alias("__meant"))
    got = addresses.join(codes, addresses.municipality_code == F.col("__code"), "left").join(meant, "id", "left")
    return got.withColumn("city", F.coalesce("__code", "__meant")).drop("__code", "__meant")

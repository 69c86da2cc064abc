"""Column expressions over the HTML of pages: head fields, links, label-value lists, and texts of sales."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pregonero.functions.parsers import first_rule, group
from pregonero.functions.text import fold
from pregonero import rules as R

TITLE = r"(?is)<title[^>]*>([^<]+)</title>"
GENERATOR = r"(?i)<meta\s+[^>]*name=[\"']generator[\"'][^>]*content=[\"']([^\"']+)[\"']"
META = r"(?i)<meta\s+[^>]*(?:name=[\"']{n}[\"']|property=[\"']og:{n}[\"'])[^>]*content=[\"']([^\"']+)[\"']"
ANCHOR = r"(?is)<a\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
PAIR = r"(?is)<dt[^>]*>(.*?)</dt>\s*<dd[^>]*>(.*?)</dd>"
PRICE = r"R\$\s*[\d.,]+"
NO_LINK = r"^(?:javascript:|mailto:|tel:|#)"
DATE = r"(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})(?!\d)"
DATE_IN_WORDS = r"(?i)(\d{1,2})\s+de\s+(\p{L}+)(?:\s+de)?\s+(\d{4})"
CLOCK = r"(?i)(?<!\d)(\d{1,2})\s*[h:](\d{2})?"
MONTHS = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]
ROUND_DATE = r"(?i)([12])[ºª°o]?\s*Leil[ãa]o\s*:\s*(\d{2}/\d{2}/\d{4})(?:[^0-9]{0,200}?(?:Preg[ãa]o[^:]*?:\s*|[àa]s\s+))?(\d{1,2}:\d{2})?"


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def title_and_generator(html: Column) -> Column:
    """PRJ20: struct(title, generator), both empty where there is none; at most 200 and 120 letters."""
    return F.struct(F.left(F.coalesce(one_line(group(html, TITLE, 1)), F.lit("")), F.lit(200)).alias("title"), F.left(F.coalesce(F.trim(group(html, GENERATOR, 1)), F.lit("")), F.lit(120)).alias("generator"))


def head_fields(html: Column) -> Column:
    """PRJ19: struct(title, description, keywords) of a page; a field of the open graph counts as the plain one."""
    meta = lambda n: F.coalesce(F.trim(group(html, META.format(n=n), 1)), F.lit(""))
    return F.struct(F.coalesce(one_line(group(html, TITLE, 1)), F.lit("")).alias("title"), meta("description").alias("description"), meta("keywords").alias("keywords"))


def labelled_pairs(html: Column) -> Column:
    """PRJ36: map of the labels and values of a definition list; the first of equal labels wins."""
    clean = lambda x: one_line(F.regexp_replace(x, "<[^>]*>", " "))
    labels = F.transform(F.regexp_extract_all(html, F.lit(PAIR), 1), lambda x: F.regexp_replace(clean(x), r"\s*:$", ""))
    values = F.transform(F.regexp_extract_all(html, F.lit(PAIR), 2), clean)
    keys = F.array_distinct(labels)
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(values, F.array_position(labels, k).cast("int"))))


def links(html: Column) -> Column:
    """Array of struct(href, text) of the links that lead to a page."""
    hrefs, texts = F.regexp_extract_all(html, F.lit(ANCHOR), 1), F.regexp_extract_all(html, F.lit(ANCHOR), 2)
    both = F.transform(F.arrays_zip(hrefs.alias("h"), texts.alias("t")), lambda z: F.struct(F.trim(z["h"]).alias("href"), one_line(F.regexp_replace(z["t"], "<[^>]*>", " ")).alias("text")))
    return F.filter(both, lambda z: (z["href"] != "") & ~F.lower(z["href"]).rlike(NO_LINK))


def link_counts(html: Column) -> Column:
    """AGG20: struct(total, useful) of the links of a page."""
    all_links = links(F.coalesce(html, F.lit("")))
    useful = F.filter(all_links, lambda z: F.lower(z["href"]).rlike("|".join(R.USEFUL_PATHS)))
    return F.struct(F.size(all_links).alias("total"), F.size(useful).alias("useful"))


def link_score(text: Column, href: Column) -> Column:
    """AGG20: struct(score, reasons) of a link as the way to a listing: the first word of its text, strong before medium, and
    the first piece of its path."""
    t, h = F.trim(fold(text)), F.lower(href)

    def first(c: Column, groups, name: str) -> tuple[Column, Column]:
        hits = [(F.when(c.contains(w), points), F.when(c.contains(w), f"{name}{sign}{w}")) for sign, points, words in groups for w in words]
        return F.coalesce(*[p for p, _ in hits], F.lit(0)), F.coalesce(*[r for _, r in hits])

    (a, ra), (b, rb) = first(t, R.LINK_TEXTS, "text"), first(h, R.LINK_PATHS, "path")
    return F.struct((a + b).alias("score"), F.array_compact(F.array(ra, rb)).alias("reasons"))


def rendering(static: Column, dynamic: Column) -> Column:
    """AGG21: how a page shows its lots, from the useful links without and with scripts."""
    more, ratio = dynamic - static, dynamic / F.greatest(static, F.lit(1))
    return (
        F.when((dynamic == 0) & (static == 0), "unknown").when(dynamic <= static, "static").when((ratio >= 1.5) & (more >= 3), "dynamic").when((ratio >= 1.1) | (more >= 2), "hybrid").otherwise("static")
    )


def needs_scripts(static: Column, dynamic: Column) -> Column:
    """AGG21: whether the lots appear only with scripts: none before, or under 30 % of at least five."""
    return (dynamic > 0) & ((static == 0) | ((dynamic >= 5) & (static * 10 < dynamic * 3)))


def document_kind(label: Column) -> Column:
    """PRJ17: kind of a document by the pieces of its label."""
    t, out = fold(F.coalesce(label, F.lit(""))), F.lit("outro")
    for needles, kind in reversed(R.DOCUMENT_KINDS):
        hit = t.contains(needles[0])
        for n in needles[1:]:
            hit = hit & t.contains(n)
        out = F.when(hit, kind).otherwise(out)
    return out


def edital_url(documents: Column) -> Column:
    """TXT6: url of the first of an array of struct(name, url) whose name says edital and not complement, or whose url does
    and ends in .pdf."""
    good = lambda x: (F.coalesce(x["url"], F.lit("")) != "") & (
        (F.lower(F.coalesce(x["name"], F.lit(""))).contains("edital") & ~F.lower(F.coalesce(x["name"], F.lit(""))).contains("complement")) | (F.lower(x["url"]).contains("edital") & F.lower(x["url"]).endswith(".pdf"))
    )
    return F.get(F.filter(documents, good), F.lit(0))["url"]


def payments(text: Column) -> Column:
    """TXT3: array of struct(kind, installments, down_payment_pct) of the ways to pay that a text names."""
    t = fold(F.coalesce(text, F.lit("")))
    number = lambda rx: F.regexp_extract(t, rx, 1).try_cast("int")
    of = lambda k: F.struct(
        F.lit(k).alias("kind"), (number(R.INSTALLMENTS) if k == "parcelado" else F.lit(None).cast("int")).alias("installments"), (number(R.DOWN_PAYMENT) if k == "parcelado" else F.lit(None).cast("int")).alias("down_payment_pct"),
    )
    return F.array_compact(F.array(*[F.when(t.rlike(rx), of(k)) for k, rx in R.PAYMENTS]))


def encumbrances(text: Column) -> Column:
    """TXT3: array of struct(kind, status) of the burdens that a text names. Where taxes pass on to the buyer by law, taxes
    and condominium fees are among them. Of declared ones the status is told by the text: passed on, before paid by the
    buyer."""
    t = fold(F.coalesce(text, F.lit("")))
    by_law, passed, buyer = t.rlike(R.TAXES_PASS_ON), t.rlike(R.PASSED_ON), t.rlike(R.BUYER_PAYS)
    declared = F.when(passed, "sub_rogado_no_lance").when(buyer, "quitado_pelo_arrematante").otherwise("declarado")
    of = lambda k, s: F.struct(F.lit(k).alias("kind"), s.alias("status"))
    named = [F.when(t.rlike(rx), of(k, declared)) for k, rx in R.ENCUMBRANCES]
    added = [F.when(by_law & ~t.rlike(dict(R.ENCUMBRANCES)[k]), of(k, F.lit("sub_rogado_no_lance"))) for k in ("iptu_em_aberto", "condominio_em_aberto")]
    return F.array_compact(F.array(*named, *added))


def merge_clauses(page: Column, document: Column) -> Column:
    """TXT4/UPS15: the clauses of a page and of its document, arrays of struct(kind, status), one per kind in the order of
    their first mention; a later one counts only if the first is merely declared and it isn't."""
    both = F.concat(page, document)
    kinds = F.array_distinct(F.transform(both, lambda x: x["kind"]))

    def of(kind: Column) -> Column:
        said = F.transform(F.filter(both, lambda x: x["kind"] == kind), lambda x: F.coalesce(x["status"], F.lit("declarado")))
        better = F.get(F.filter(said, lambda s: s != "declarado"), F.lit(0))
        return F.struct(kind.alias("kind"), F.coalesce(F.when(F.get(said, F.lit(0)) != "declarado", F.get(said, F.lit(0))), better, F.lit("declarado")).alias("status"))

    return F.transform(kinds, of)


def br_datetime(text: Column) -> Column:
    """PRJ8/PRJ9: the first date of a text (day/month/year with two or four digits, else day de month de year) with the clock
    after it, as yyyy-MM-ddTHH:mm:ss-03:00; an impossible date or clock gives null."""
    numeric = F.regexp_extract(text, DATE, 0) != ""
    wrote = F.when(numeric, F.regexp_extract(text, DATE, 0)).otherwise(F.nullif(F.regexp_extract(text, DATE_IN_WORDS, 0), F.lit("")))
    after = F.substr(text, F.instr(text, wrote) + F.length(wrote))
    name = fold(F.regexp_extract(text, DATE_IN_WORDS, 2))
    known = F.when(name.rlike("^(" + "|".join(MONTHS) + ")$") | name.isin("janeiro", "fevereiro", "marco", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"), F.left(name, F.lit(3)))
    month = F.when(numeric, F.regexp_extract(text, DATE, 2)).otherwise(F.array_position(F.lit(MONTHS), known).cast("string"))
    year = F.when(numeric, F.regexp_extract(text, DATE, 3)).otherwise(F.regexp_extract(text, DATE_IN_WORDS, 3))
    day = F.when(numeric, F.regexp_extract(text, DATE, 1)).otherwise(F.regexp_extract(text, DATE_IN_WORDS, 1))
    two = lambda c: F.lpad(c, 2, "0")
    hour, minute = F.coalesce(group(after, CLOCK, 1), F.lit("0")), F.coalesce(group(after, CLOCK, 2), F.lit("0"))
    iso = F.concat(F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year), F.lit("-"), two(month), F.lit("-"), two(day))
    good = iso.try_cast("date").isNotNull() & (hour.try_cast("int") < 24) & (minute.try_cast("int") < 60)
    return F.when(good, F.concat(iso, F.lit("T"), two(hour), F.lit(":"), two(minute), F.lit(":00-03:00")))


def two_round_dates(text: Column) -> Column:
    """PRJ10: struct(first, second) of `1º Leilão: date [... clock]` as dd/MM/yyyy HH:mm; the first mention of each counts, a
    missing clock is 00:00."""
    g = lambda i: F.regexp_extract_all(text, F.lit(ROUND_DATE), i)
    rounds = F.arrays_zip(g(1).alias("n"), g(2).alias("d"), g(3).alias("h"))
    value = lambda z: F.concat(z["d"], F.lit(" "), F.coalesce(F.nullif(z["h"], F.lit("")), F.lit("00:00")))
    of = lambda n: F.get(F.transform(F.filter(rounds, lambda z: z["n"] == n), value), F.lit(0))
    return F.struct(of("1").alias("first"), of("2").alias("second"))


def site_score(fields: dict[str, Column]) -> Column:
    """AGG19/TXT5: struct(score, signals, confidence) of an auction site as one of property: words found per field, at most
    three of each strength, times their weights; high needs a strong word."""
    score, signals = F.lit(0.0), []
    for name, text in fields.items():
        t, weights = fold(F.coalesce(text, F.lit(""))), R.FIELD_WEIGHTS[name]
        for words, sign, w in ((R.STRONG_WORDS, "+", weights[0]), (R.MEDIUM_WORDS, "~", weights[1])):
            hits = F.array_compact(F.array(*[F.when(t.contains(x), f"{name}{sign}{x}") for x in words]))
            score = score + F.least(F.size(hits), F.lit(3)) * w
            signals.append(F.slice(hits, 1, 3))
    said, total = F.flatten(F.array(*signals)), F.round(score, 2)
    strong = F.exists(said, lambda s: s.contains("+"))
    return F.struct(total.alias("score"), said.alias("signals"), F.when(strong & (total >= R.HIGH_SCORE), "high").when(total >= R.MEDIUM_SCORE, "medium").otherwise("unknown").alias("confidence"))


def listing_is_property(text: Column) -> Column:
    """FLT6: true with a sign of property, false with one of a vehicle alone, else null."""
    t = fold(text)
    return F.when(t.rlike(R.PROPERTY_SIGNS), True).when(t.rlike(R.VEHICLE_SIGNS), False)


def page_is_property(title: Column, description: Column) -> Column:
    """FLT7: whether title or description, without the date before it, has a sign of property; no sign is false."""
    t = fold(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit(""))))
    return F.regexp_replace(t, R.DATE_PREFIX, " ").rlike(R.PROPERTY_STRICT)


def title_is_property(text: Column) -> Column:
    """FLT8: looser: a property word counts whatever else the title names."""
    return F.coalesce(fold(text).rlike(R.PROPERTY_LOOSE), F.lit(False))


def is_lot_url(url: Column) -> Column:
    """FLT8: not a page of information, a listing or a login."""
    return ~F.lower(url).rlike(R.NOT_A_LOT)


def property_kind(*candidates: Column) -> Column:
    """PRJ12: the first kind that one of the texts gives."""
    return F.coalesce(*[first_rule(c, R.PROPERTY_RULES) for c in candidates])

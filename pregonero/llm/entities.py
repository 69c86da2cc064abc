"""Problem 2: variant spellings of names -> one entity, by merging and matching again.

A profile is what is known of one entity so far: all spellings of its name, its registrations and e-mails. Matched
profiles merge, the merged profile holds the union, and richer profiles enter blocking again: an initial that matched
nothing may match the name that another record spelt out. Two profiles are as alike as the two spellings of them that
are most alike. Rounds go on until no two profiles merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pregonero.functions.text import edit_distance, fold, normalise_uf, words
from pregonero.functions.timestamps import barrier
from pregonero.llm.addresses import mine_rewrites, rewrite
from pregonero.llm.canonical_list import sound
from pregonero.llm.components import hash_to_min
from pregonero.session import cut

# Registration boards by state.
BOARDS = {
    "jucesp": "SP", "jucerja": "RJ", "jucemg": "MG", "jucesc": "SC", "juceg": "GO", "jucec": "CE", "jucisrs": "RS", "jucepar": "PR", "jucees": "ES",
    "jcdf": "DF", "jucepi": "PI", "jucemat": "MT", "jucepe": "PE", "juceb": "BA", "juceal": "AL", "jucer": "RO", "jucese": "SE", "jucepa": "PA",
    "jucern": "RN", "jucerr": "RR", "jucep": "PB", "jucetins": "TO", "juceac": "AC", "jucema": "MA", "jucap": "AP", "jucea": "AM", "jucems": "MS",
}
# Courtesy and office words, marks of generations, legal forms and activities of firms.
COURTESY = r"^(?:(?:sr|sra|dr|dra|doutor|doutora|da|dona|l\w{0,4}loeir[oa]|leil publico)\b\s*(?:\ba\b\s+)?)+"
OFFICE = r"\b(?:leiloeir[oa](?:\s?a)? (?:publico |publica )?oficial|leiloeir[oa] public[oa]|leil publico|leiloeiro oficial|e outr[oa]s)\b"
GENERATIONS = {"filho": "filho", "fo": "filho", "f": "filho", "neto": "neto", "nto": "neto", "junior": "junior", "jr": "junior", "sobrinho": "sobrinho", "sob": "sobrinho"}
FORMS = ["ltda", "limitada", "eireli", "me", "sa", "epp", "ss"]
ACTIVITIES = {"leiloes": "leil", "leil": "leil", "leilao": "leil", "pregoes": "preg", "preg": "preg", "alienacoes": "alien", "alien": "alien",
              "hastas": "hasta", "hasta": "hasta", "publicas": "", "pub": "", "judiciais": "jud", "jud": "jud", "assessoria": "asses", "asses": "asses"}
ACCEPT = 0.8
#: Registrations of one board at most this far apart may be one that was typed wrong.
CLOSE = 300


def _near(token: Column, known: list[str], slack: Column | None = None) -> Column:
    """The known word that a token is, slips of one letter from four letters and of two from eight included."""
    exact = F.when(token.isin(known), token)
    close = [F.when((F.length(token) >= 4) & (edit_distance(token, F.lit(k)) <= (2 if len(k) >= 8 else 1)), F.lit(k)) for k in known if len(k) >= 4]
    return F.coalesce(exact, *close)


def read_names(records: DataFrame) -> DataFrame:
    """(record_id, state, reg, email, firm, gen, names): names without courtesy, in the order first to last."""
    board = F.regexp_replace(fold(F.col("junta_sigla")), "[^a-z]", "")
    ends = [s.lower() for s in BOARDS.values()]
    boards = F.create_map(*[F.lit(x) for kv in BOARDS.items() for x in kv])
    tail = F.upper(F.right(board, F.lit(2)))
    spelt = F.when(board.rlike("^(?:jc|juntacomercial)[a-z]{2}$") | board.rlike(r"^(?:" + "|".join(BOARDS) + r")(?:" + "|".join(ends) + r")$") | board.rlike(r"^juc[ei]s?(?:" + "|".join(ends) + ")$"), tail)
    of_board = F.coalesce(F.try_element_at(boards, board), F.when(spelt.isin(list(BOARDS.values())), spelt))
    mat = F.coalesce(fold(F.col("matricula")), F.lit(""))
    of_mat = F.coalesce(F.try_element_at(boards, F.nullif(F.regexp_extract(mat, r"\b(j[a-z]{3,})\b", 1), F.lit(""))), normalise_uf(F.regexp_extract(mat, r"\d\s*[-/]\s*([a-z]{2})\s*$", 1)))
    reg = F.nullif(F.regexp_replace(F.regexp_replace(mat, r"\D", ""), "^0+", ""), F.lit(""))
    email = F.lower(F.trim("innlei_email"))
    raw = fold(F.regexp_replace(F.coalesce(F.col("nome"), F.lit("")), r"(?i)f[º°ª]", "filho"))
    raw = F.regexp_replace(raw, r"\([^)]*\)", " ")
    raw = F.regexp_replace(F.regexp_replace(raw, r"\bs/a\b|\bs\.a\b\.?", " sa "), r"\bm\.e\b\.?", " me ")
    step = barrier(records, ["record_id"], {"state": F.coalesce(of_board, normalise_uf(F.col("uf")), of_mat), "reg": reg, "email": email, "__n": raw})
    flat = lambda c: F.trim(F.regexp_replace(F.trim(F.regexp_replace(words(c), OFFICE, " ")), COURTESY, ""))
    head, tail_ = F.split("__n", ",")[0], F.trim(F.regexp_replace("__n", r"^[^,]*,", ""))
    turned = F.when(F.instr("__n", ",") > 0, F.concat_ws(" ", flat(tail_), flat(head))).otherwise(flat(F.col("__n")))
    step = barrier(step, ["record_id", "state", "reg", "email"], {"__t": F.filter(F.split(F.trim(turned), r"\s+"), lambda t: t != "")})
    gens = F.create_map(*[F.lit(x) for kv in GENERATIONS.items() for x in kv])
    acts = F.create_map(*[F.lit(x) for kv in ACTIVITIES.items() for x in kv])
    firm = F.exists("__t", lambda t: _near(t, [f for f in FORMS if len(f) > 2]).isNotNull() | t.isin("me", "sa") | _near(t, list(ACTIVITIES)).isNotNull())
    step = barrier(step, ["record_id", "state", "reg", "email", "__t"], {"firm": firm})
    # a slip of a short mark is one only at the end of a name
    at_end = lambda t: (F.size("__t") > 2) & (t == F.element_at("__t", -1)) & (F.length(t) >= 3)
    slip = lambda t: F.coalesce(*[F.when(at_end(t) & (edit_distance(t, F.lit(k)) <= (1 if len(k) < 8 else 3)), F.lit(k)) for k in GENERATIONS if len(k) >= 3])
    gen_of = lambda t: F.when(F.length(t) > 1, F.try_element_at(gens, F.coalesce(F.when(t.isin(list(GENERATIONS)), t), slip(t))))
    gen = F.filter(F.transform("__t", gen_of), lambda g: g.isNotNull())
    person = F.filter("__t", lambda t: gen_of(t).isNull() & ~t.isin("de", "da", "do", "das", "dos", "e"))
    company = F.filter(F.transform("__t", lambda t: F.coalesce(F.concat(F.lit("@"), F.try_element_at(acts, _near(t, list(ACTIVITIES)))), t)), lambda t: (t != "@") & _near(t, FORMS).isNull())
    return step.select(
        "record_id", "state", "reg", F.when(F.instr("email", "@") > 0, F.col("email")).alias("email"), F.coalesce("firm", F.lit(False)).alias("firm"),
        F.when(F.col("firm"), F.lit("")).otherwise(F.coalesce(F.get(gen, F.lit(0)), F.lit(""))).alias("gen"), F.when(F.col("firm"), F.array_distinct(company)).otherwise(person).alias("names"),
    )


def token_similarity(x: Column, y: Column) -> Column:
    d = edit_distance(x, y)
    least = F.least(F.length(x), F.length(y))
    initial = (least == 1) & (F.substring(x, 1, 1) == F.substring(y, 1, 1))
    return (
        F.when(x == y, 1.0).when(initial, 0.75).when((d == 1) & (least >= 3), 0.9).when((d == 2) & (least >= 6), 0.8).when((d == 3) & (least >= 9), 0.7).otherwise(0.0)
    )


def with_similarity(pairs: DataFrame) -> DataFrame:
    """Replace a_names and b_names by what the shorter name has in the longer: sim, the mean similarity; real, names
    found up to one letter (activities of firms aside); initials found; missed, names not found; uneven, whether more
    of the longer is left over than it is longer by; short, its length; even, whether both are as long."""
    keep = [c for c in pairs.columns if c not in ("a_names", "b_names")]
    x, y = F.col("a_names"), F.col("b_names")
    first = F.size(x) <= F.size(y)
    step = barrier(pairs, keep, {"__s": F.when(first, x).otherwise(y), "__l": F.when(first, y).otherwise(x)})
    to = lambda p, q: F.transform(p, lambda t: F.array_max(F.transform(q, lambda u: token_similarity(t, u))))
    step = barrier(step, [*keep, "__s", "__l"], {"__best": to("__s", "__l"), "__back": to("__l", "__s")})
    count = lambda f: F.size(F.filter("__best", f))
    return barrier(step, keep, {
        "sim": F.aggregate("__best", F.lit(0.0), lambda s, v: s + v) / F.greatest(F.size("__s"), F.lit(1)),
        "real": F.size(F.filter(F.arrays_zip(F.col("__s").alias("t"), F.col("__best").alias("v")), lambda z: (z.v > 0.89) & ~z.t.startswith("@"))),
        "initials": count(lambda v: F.abs(v - 0.75) < 0.01), "missed": count(lambda v: v == 0.0),
        "uneven": F.size(F.filter("__back", lambda v: v == 0.0)) > F.size("__l") - F.size("__s"), "short": F.size("__s"), "even": F.size("__s") == F.size("__l"),
    })


def _block_keys(profiles: DataFrame) -> DataFrame:
    """(pid, key, reg), key a hash: registration in its state, or with a name where the state is missing; personal e-mail; a
    name with the initial of another one of its spelling, in the state. reg is the registration of a profile that has one,
    on the keys of names alone."""
    state = F.coalesce("state", F.lit("?"))
    full = F.filter("names", lambda t: F.length(t) > 1)
    none = F.array().cast("array<string>")
    cross = F.flatten(F.transform(full, lambda t: F.transform(F.filter("names", lambda o: o != t), lambda o: F.concat_ws("|", F.lit("n"), state, sound(t), F.substring(o, 1, 1)))))
    alone = F.when(F.size("names") == 1, F.array(F.concat_ws("|", F.lit("n"), state, sound(F.col("names")[0]), F.lit("")))).otherwise(none)
    of_profile = F.concat(F.transform("regs", lambda r: F.concat_ws("|", F.lit("r"), state, r)), F.transform("emails", lambda e: F.concat_ws("|", F.lit("e"), e)))
    of_spelling = F.concat(
        F.flatten(F.transform("regs", lambda r: F.transform(full, lambda t: F.concat_ws("|", F.lit("x"), r, sound(t))))),
        F.when(F.col("state").isNotNull(), F.concat(F.array_distinct(cross), alone)).otherwise(none),
    )
    only = F.when(F.size("regs") == 1, F.get("regs", F.lit(0))).alias("reg")
    spelt = profiles.select("pid", "state", "regs", F.explode("spellings").alias("names"))
    rows = profiles.select("pid", F.explode(of_profile).alias("k"), only).unionByName(spelt.select("pid", F.explode(of_spelling).alias("k"), only))
    return rows.select("pid", F.xxhash64("k").alias("key"), F.when(F.col("k").startswith("n|"), F.col("reg")).alias("reg")).distinct()


def _close(x: Column, y: Column) -> Column:
    """Whether two registrations may be one that was typed wrong."""
    return (F.levenshtein(x, y) <= 1) | (F.abs(x.try_cast("long") - y.try_cast("long")) <= CLOSE)


def _candidates(profiles: DataFrame) -> DataFrame:
    """Distinct (a_pid, b_pid), smaller first, that share a key which may join them: by names alone two registrations must
    be close, so within the join most pairs of a frequent name end before they are rows."""
    keys = _block_keys(profiles)
    a, b = (keys.select("key", F.col("pid").alias(f"{s}_pid"), F.col("reg").alias(f"{s}_reg")) for s in "ab")
    known = F.col("a_reg").isNotNull() & F.col("b_reg").isNotNull()
    return a.join(b, "key").where((F.col("a_pid") < F.col("b_pid")) & (~known | F.coalesce(_close(F.col("a_reg"), F.col("b_reg")), F.lit(False)))).select("a_pid", "b_pid").distinct()


def _matches(profiles: DataFrame) -> DataFrame:
    """(a, b) of profiles that are one entity."""
    info = profiles.select("pid", "state", "gen", "firm", "spellings", "regs", "emails")
    side = lambda s: info.select(*[F.col(c).alias(f"{s}_{c}") for c in info.columns])
    pairs = _candidates(profiles).join(side("a"), "a_pid").join(side("b"), "b_pid")
    # the cheap facts first: most pairs hold two registrations that differ, and no rule joins those
    step = barrier(pairs, ["a_pid", "b_pid", "a_spellings", "b_spellings"], {
        "gen": F.col("a_gen") == F.col("b_gen"), "firm": F.col("a_firm") == F.col("b_firm"), "is_firm": F.col("a_firm") & F.col("b_firm"),
        "reg": F.arrays_overlap("a_regs", "b_regs"), "apart": (F.size("a_regs") > 0) & (F.size("b_regs") > 0) & ~F.arrays_overlap("a_regs", "b_regs"),
        "email": F.arrays_overlap("a_emails", "b_emails"), "mails": (F.size("a_emails") > 0) & (F.size("b_emails") > 0) & ~F.arrays_overlap("a_emails", "b_emails"),
        "a_reg": F.size("a_regs") > 0, "b_reg": F.size("b_regs") > 0, "held_regs": F.array_union("a_regs", "b_regs"), "state": F.coalesce(F.col("a_state") == F.col("b_state"), F.lit(False)),
        "states": F.coalesce(F.col("a_state") != F.col("b_state"), F.lit(False)),
        "close": F.exists("a_regs", lambda x: F.exists("b_regs", lambda y: _close(x, y))),
    })
    step = step.where("gen and (reg or email or (state and firm and not mails and (not apart or close)))")
    # every spelling of one with every spelling of the other
    step = step.withColumn("a_names", F.explode("a_spellings")).drop("a_spellings").withColumn("b_names", F.explode("b_spellings")).drop("b_spellings")
    step = with_similarity(step)
    c = F.col
    alike = (c("real") >= 1) & ((c("missed") == 0) | ((c("missed") == 1) & (c("real") + c("initials") >= 2)))
    brief = (c("real") >= 1) & ((c("short") == 2) | (c("is_firm") & (c("missed") <= 1)))  # a nickname and the surname; a firm with one bad word
    same_reg = c("reg") & c("gen") & ((c("state") & (alike | brief)) | (~c("states") & (c("real") >= 2) & (c("missed") == 0)))
    same_mail = c("email") & ~c("states") & c("gen") & (alike | (c("missed") == 0))
    by_name = c("state") & c("gen") & c("firm") & (c("missed") == 0) & ~c("uneven") & (c("sim") >= ACCEPT) & ~c("mails")
    slip = by_name & c("apart") & c("close") & ((c("real") >= 3) | ((c("real") == 2) & (c("is_firm") | (c("even") & (c("initials") >= 1)))))
    loose = by_name & ~c("apart") & ((c("real") >= 2) | (c("is_firm") & (c("sim") > 0.99)))
    judged = step.select("a_pid", "b_pid", "a_reg", "b_reg", "held_regs", "sim", "real", (same_reg | same_mail).alias("sure"), slip.alias("slip"), loose.alias("loose"))
    judged = judged.where(c("sure") | c("slip") | c("loose")).groupBy("a_pid", "b_pid", "a_reg", "b_reg", "held_regs").agg(
        *[F.max(x).alias(x) for x in ("sure", "slip", "loose")], F.max(F.when(c("loose"), F.round(c("sim") + c("real") * 0.2, 3))).alias("s"),
    )
    judged = cut(judged)
    # a profile without registration joins the one registered profile that its name fits best, or those if all have one
    # registration (of the state, as loose is within one); another tie is left open
    to = judged.where(~c("sure") & c("loose") & (c("a_reg") != c("b_reg"))).select(
        F.when(c("a_reg"), c("b_pid")).otherwise(c("a_pid")).alias("free"), F.when(c("a_reg"), c("a_pid")).otherwise(c("b_pid")).alias("held"), "held_regs", "s",
    )
    best = to.groupBy("free").agg(F.max("s").alias("s"))
    tied = to.join(best, ["free", "s"])
    of_reg = tied.select("free", "held", F.explode("held_regs").alias("reg")).groupBy("free", "reg").agg(F.count("*").alias("k")).groupBy("free").agg(F.max("k").alias("k"))
    top = tied.groupBy("free").agg(F.min("held").alias("held"), F.count("*").alias("n")).join(of_reg, "free")
    free_free = judged.where(~c("sure") & c("loose") & ~c("a_reg") & ~c("b_reg")).select(c("a_pid").alias("a"), c("b_pid").alias("b"))
    placed = to.select(c("free").alias("p")).distinct()
    open_ = free_free.join(placed, c("a") == c("p"), "left_anti").join(placed, c("b") == c("p"), "left_anti")
    return (
        judged.where("sure or slip").select(c("a_pid").alias("a"), c("b_pid").alias("b"))
        .unionByName(top.where("n = k").select(c("free").alias("a"), c("held").alias("b"))).unionByName(open_)
    )


def _fold(rows: DataFrame, by: str) -> DataFrame:
    """Profiles of groups: all spellings (an empty one only if there is no other), registrations and e-mails."""
    union = lambda c: F.array_distinct(F.flatten(F.collect_set(c)))
    spelt = F.filter(union("spellings"), lambda x: F.size(x) > 0)
    return rows.groupBy(F.col(by).alias("pid")).agg(
        F.max("state").alias("state"), F.max_by("gen", F.struct("n", "gen")).alias("gen"), F.max_by("firm", F.struct("n", "firm")).alias("firm"),
        F.when(F.size(spelt) > 0, spelt).otherwise(F.array(F.array().cast("array<string>"))).alias("spellings"), union("regs").alias("regs"), union("emails").alias("emails"), F.sum("n").alias("n"),
    )


def _office_mails(rows: DataFrame) -> DataFrame:
    """(email) of the mailboxes of offices: those with registrations of several boards, or whose registrations don't agree on
    the name: no two names (or the only one) are those of half of them. How many registrations there are doesn't matter,
    so one person's registration may be typed in any number of ways."""
    held = rows.where(F.col("reg").isNotNull() & F.col("email").isNotNull()).select("email", "state", "reg", "names")
    of_mail = held.groupBy("email").agg(F.count_distinct("state", "reg").alias("k"), F.count_distinct("state").alias("boards"))
    full = F.array_distinct(F.transform(F.filter("names", lambda t: F.length(t) > 1), sound))
    told = held.select("email", F.concat_ws("|", "state", "reg").alias("place"), F.explode(full).alias("t")).distinct().groupBy("email", "t").agg(F.count("*").alias("m"))
    common = told.join(of_mail, "email").groupBy("email").agg(F.count_if(F.col("m") * 2 >= F.col("k")).alias("common"), F.count("*").alias("all"))
    got = of_mail.where("k > 1").join(common, "email", "left")
    return got.where((F.col("boards") > 1) | (F.coalesce("common", F.lit(0)) < F.least(F.lit(2), F.coalesce("all", F.lit(1))))).select("email")


def resolve(records: DataFrame) -> DataFrame:
    """(record_id, entity) with equal entity for records of one person or organisation.

    Repeated records collapse into one profile first. Names that share no letter, empty names without registration or
    e-mail stay alone. Rounds go on until no two profiles match; each leaves fewer of them. E-mails of offices count for nothing.
    """
    got = cut(read_names(records))
    # nicknames and slips that stand for each other under one registration
    held = got.where(F.col("reg").isNotNull() & F.col("state").isNotNull() & ~F.col("firm") & (F.size("names") > 1))
    said = held.groupBy(F.concat_ws("|", "state", "reg").alias("place"), F.array_join("names", " ").alias("street")).agg(F.count("*").alias("n"))
    aliases = cut(mine_rewrites(said, initials=False))
    texts = got.where(F.size("names") > 0).select(F.array_join("names", " ").alias("street")).distinct()
    new = rewrite(texts, aliases)
    got = got.withColumn("street", F.array_join("names", " ")).join(new, "street", "left").withColumn("names", F.when(F.col("to").isNotNull(), F.split("to", " ")).otherwise(F.col("names"))).drop("street", "to")
    offices = _office_mails(got).withColumn("office", F.lit(True))
    got = got.join(offices, "email", "left").withColumn("email", F.when(F.col("office").isNull(), F.col("email"))).drop("office")
    base = got.withColumn("pid", F.xxhash64(F.coalesce("state", F.lit("")), F.coalesce("reg", F.lit("")), F.coalesce("email", F.lit("")), "gen", F.array_join("names", " "), F.when(F.size("names") == 0, F.col("record_id")).otherwise(0)))
    base = cut(base)
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(c)).otherwise(F.array().cast("array<string>"))
    profiles = base.groupBy("pid", "state", "gen", "firm", F.array("names").alias("spellings"), one("reg").alias("regs"), one("email").alias("emails")).agg(F.count("*").alias("n"))
    profiles = cut(_fold(profiles, "pid"))
    member = base.select("record_id", F.col("pid").alias("entity"))
    while True:
        links = cut(_matches(profiles))
        if links.isEmpty():
            break
        groups = cut(hash_to_min(links, "a", "b"))
        profiles = cut(_fold(profiles.join(groups, profiles.pid == groups.id, "left").withColumn("to", F.coalesce("group_id", "pid")).drop("id", "group_id", "pid"), "to"))
        member = cut(member.join(groups, member.entity == groups.id, "left").select("record_id", F.coalesce("group_id", "entity").alias("entity")))
    return member


def named_by_smallest(member: DataFrame) -> DataFrame:
    """(record_id, entity_id): the members, each entity by its smallest record."""
    least = member.groupBy("entity").agg(F.min("record_id").alias("entity_id"))
    return member.join(least, "entity").select("record_id", "entity_id").distinct()


def same_entity_pairs(member: DataFrame) -> DataFrame:
    """(record_id_a, record_id_b), smaller first, of all records of one entity."""
    l, r = member.alias("l"), member.alias("r")
    return l.join(r, F.col("l.entity") == F.col("r.entity")).where(F.col("l.record_id") < F.col("r.record_id")).select(F.col("l.record_id").alias("record_id_a"), F.col("r.record_id").alias("record_id_b")).distinct()

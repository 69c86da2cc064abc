"""Which platform a page is built on: ordered rules as data. A rule gives its provider, confidence and signal if one of its
alternatives holds; an alternative is a list of tests that must all hold.

A test is (field, how, needle): html, signals, stack and generator are lower-case texts; host is the lower-case host of the
page's address. how: has, ends, starts, is (equal), like (regex), under (fewer characters than the needle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HTML = lambda *needles: [[("html", "has", n)] for n in needles]
HOST = lambda how, *needles: [[("host", how, n)] for n in needles]
#: Signals that name the host or the stack of the page.
HOST_SIGNAL, STACK_SIGNAL = "host=", "stack="

# Providers in the order of the rules, with confidence, signal and needles.
PROVIDERS = [
    ("soleon", "high", "meta_author=SOLEON", HTML('name="author" content="soleon')),
    ("soleon", "high", "footer:Tecnologia SOLEON", HTML("tecnologia soleon")),
    ("soleon", "medium", "link:soleon.com.br", HTML("soleon.com.br")),
    ("leilao_br", "high", HOST_SIGNAL, HOST("ends", ".leilao.br") + HOST("is", "leilao.br")),
    ("leilao_br", "medium", "tech_signals+html=leilao.br", [[("signals", "has", "leilao.br"), ("html", "has", "leilao.br")], [("stack", "has", "leilao.br platform"), ("html", "has", "leilao.br")]]),
    ("suporte_leiloes", "high", HOST_SIGNAL, HOST("ends", ".suporteleiloes.com.br")),
    ("suporte_leiloes", "high", "cdn.suporteleiloes.com.br", HTML("cdn.suporteleiloes.com.br")),
    ("suporte_leiloes", "medium", "link:suporteleiloes.com.br", HTML("suporteleiloes.com.br")),
    ("sishp", "high", "path=/sishp/", HTML("/sishp/leilao/", "/sishp/lote/")),
    ("sishp", "medium", "lancetotal/lancenoleilao link", HTML("lancenoleilao.com.br", "lancetotal.com.br")),
    ("sishp", "medium", "string:sishp", [[("html", "like", r"\bsishp\b")]]),
    ("leilao_pro", "high", "meta_author=Leilão Pro", HTML('name="author" content="leilão pro', 'name="author" content="leilao pro')),
    ("leilao_pro", "high", "link:leilao.pro", HTML("https://www.leilao.pro", "://leilao.pro")),
    ("leilotech", "high", "leilotech.com.br", HTML("leilotech.com.br", "leilotech.workers.dev")),
    ("plataforma_leiloar", "high", "plataformaleiloar.com.br", HTML("plataformaleiloar.com.br")),
    ("plataforma_leiloar", "high", "meta_author=Plataforma Leiloar", HTML('name="author" content="plataforma leiloar')),
    ("leiloes_judiciais_br", "high", "leiloesjudiciaisbrasil/cesvibrasil", HTML("leiloesjudiciaisbrasil.com.br", "atendimento.leiloesjudiciais.com.br", "cesvibrasil.com.br")),
    ("bomvalor", "high", "bomvalor.com.br", HTML("bomvalor.com.br")),
    ("palacio_dos_leiloes", "high", HOST_SIGNAL, HOST("has", "palaciodosleiloes")),
    ("palacio_dos_leiloes", "high", "meta_author", HTML('name="author" content="palácio dos leilões')),
    ("s4b_digital", "high", "s4bdigital.net", HTML("s4bdigital.net")),
    ("parked_ww17", "medium", "host=ww17.* + html<5KB", [[("host", "starts", "ww17."), ("html", "under", "5000")]]),
    ("softgt", "high", "link:softgt.com.br", HTML("softgt.com.br")),
    ("softgt", "high", "meta_author=SoftGT", HTML('name="author" content="softgt')),
    ("softgt", "medium", "footer:SoftGT", HTML("softgt - todos os direitos", "softgt informatica")),
    (
        "inertia_laravel_leiloes", "high", "<title inertia>+data-page=component+vite/build",
        [[("html", "has", "<title inertia"), ("html", "has", 'data-page="{&quot;component&quot;'), ("html", "has", n)] for n in ("/build/assets/", "inertia-vendor")],
    ),
    ("portal_zuk", "high", HOST_SIGNAL, HOST("ends", "portalzuk.com.br")),
    ("portal_zuk", "medium", "asset/class portalzuk", HTML("portalzuk.com.br") + [[("html", "has", "card-property"), ("html", "has", "property-prices")]]),
    ("leiloesbr", "high", "leiloesbr.com.br + ASP routes", [[("html", "has", "leiloesbr.com.br"), ("html", "has", n)] for n in ("peca.asp", "catalogo.asp")]),
    ("leiloesbr", "high", "footer:Powered by LeilõesBR", HTML("powered by leilõesbr")),
    ("leiloesbr", "medium", "link:leiloesbr.com.br", HTML("leiloesbr.com.br")),
    ("leiloesweb", "high", "link:leiloesweb.com.br", HTML("leiloesweb.com.br")),
    ("wix", "high", "wix/parastorage", [[("generator", "has", "wix.com")]] + HTML("parastorage.com", "wixstatic.com")),
    ("degrau_publicidade", "medium", "link:degraupublicidade.com.br", HTML("degraupublicidade.com.br")),
    ("degrau_publicidade", "high", "asset:/dg-temas/ ou ApiEngine", HTML("/dg-temas/")),
    ("superbid", "high", HOST_SIGNAL, HOST("has", "superbid")),
    ("mega_leiloes", "high", HOST_SIGNAL, HOST("has", "megaleiloes")),
    ("mega_leiloes", "medium", "link:megaleiloes.com.br", HTML("megaleiloes.com.br")),
    ("sodre_santoro", "high", "sodresantoro", HOST("has", "sodresantoro") + HTML("sodresantoro.com.br")),
    ("leilovip", "high", "leilovip", HOST("has", "leilovip") + [[("signals", "has", "leilovip")]]),
    ("biddo", "medium", "tech_signals=biddo", [[("signals", "has", "biddo")], [("stack", "has", "biddo")]]),
    ("e_leiloes", "medium", "E-LEILÕES + leilao.br/nuxt", [[("html", "has", a), ("html", "has", b)] for a in ("e-leil&otilde;es", "e-leilões") for b in ("leilao.br", "_nuxt")]),
    ("wordpress", "medium", "stack=WordPress", [[("stack", "has", "wordpress")], [("generator", "has", "wordpress")]]),
    ("wordpress", "medium", "path=/wp-content/", HTML("/wp-content/", "/wp-includes/")),
    ("proprio_html", "low", STACK_SIGNAL, [[("stack", "has", "jquery")], [("stack", "has", "bootstrap")]]),
]
NO_HTML, NO_RULE = ("cache_missing", "n/a", "no html cache"), ("desconhecido", "n/a", "no rule matched")

# Technologies by their generator, by pieces of the page, and the signal of each; servers by their header.
GENERATORS = [("WordPress", "wordpress"), ("Wix", "wix"), ("Squarespace", "squarespace"), ("Joomla", "joomla"), ("Drupal", "drupal"), ("Shopify", "shopify"), ("Elementor", "elementor")]
TECHNOLOGIES = [
    ("WordPress", "wp-content/wp-includes", ["wp-content/", "wp-includes/"]), ("Next.js", "/_next/ or __NEXT_DATA__", ["/_next/", "__next_data__", "self.__next_f"]), ("Nuxt", "/_nuxt/ or __NUXT__", ["/_nuxt/", "window.__nuxt__"]),
    ("React", "data-reactroot/react-dom", ["data-reactroot", "react-dom", "_react_"]), ("Vue", "vue.js/v-cloak/data-v-", ["vue.js", "v-cloak", "data-v-"]), ("Angular", "ng-app/ng-controller", ["ng-app", "ng-controller", "ng-version"]),
    ("jQuery", "jquery", ["jquery"]), ("Bootstrap", "bootstrap", ["bootstrap"]), ("leilao.br platform", "leilao.br", [".leilao.br"]), ("Sodré Santoro", "sodresantoro", ["sodresantoro"]), ("Mega Leilões", "megaleiloes", ["megaleiloes"]),
    ("LeilôVIP", "leilovip", ["leilovip"]), ("Biddo", "biddo", ["biddo"]), ("Superbid", "superbid", ["superbid"]),
]
MENTION = ("contains 'leilo'", ["leilo ", "/leilo-", "leilo.com"])
SERVERS = ["cloudflare", "nginx", "apache"]
MOST_SIGNALS = 12


def _test(fields: dict[str, Column], field: str, how: str, needle: str) -> Column:
    c = fields[field]
    tests = {
        "has": lambda: c.contains(needle), "ends": lambda: c.endswith(needle), "starts": lambda: c.startswith(needle), "is": lambda: c == needle, "like": lambda: c.rlike(needle), "under": lambda: F.length(c) < int(needle),
    }
    return tests[how]()


def detect_provider(html: Column, host: Column, signals: Column, stack: Column, generator: Column) -> Column:
    """TXT1: struct(provider, confidence, signal) of the first rule that holds; a page without html has no cache."""
    fields = {k: F.coalesce(v, F.lit("")) for k, v in {"html": F.lower(html), "host": host, "signals": F.lower(signals), "stack": F.lower(stack), "generator": F.lower(generator)}.items()}
    answer = lambda p, c, s: F.struct(F.lit(p).alias("provider"), F.lit(c).alias("confidence"), s.alias("signal"))
    out = F.when(fields["html"] == "", answer(*NO_HTML[:2], F.lit(NO_HTML[2])))
    for provider, confidence, signal, alternatives in PROVIDERS:
        said = {HOST_SIGNAL: F.concat(F.lit("host="), fields["host"]), STACK_SIGNAL: F.concat(F.lit("stack="), fields["stack"])}.get(signal, F.lit(signal))
        holds = None
        for tests in alternatives:
            every = None
            for t in tests:
                every = _test(fields, *t) if every is None else every & _test(fields, *t)
            holds = every if holds is None else holds | every
        out = out.when(holds, answer(provider, confidence, said))
    return out.otherwise(answer(*NO_RULE[:2], F.lit(NO_RULE[2])))


def detect_technologies(html: Column, generator: Column, url: Column, server: Column) -> tuple[Column, Column]:
    """TXT2: (distinct technologies in the order of their signs, the first MOST_SIGNALS signals)."""
    low, gen, where, by = (F.lower(F.coalesce(c, F.lit(""))) for c in (html, generator, url, server))
    labels, signals = [], [F.when(gen != "", F.concat(F.lit("generator="), F.left(generator, F.lit(60))))]
    named = F.coalesce(*[F.when(gen.contains(n), label) for label, n in GENERATORS])
    labels.append(named)
    signals.append(F.when(named.isNotNull(), F.concat(F.lit("generator="), F.left(generator, F.lit(40)))))
    for label, signal, needles in TECHNOLOGIES:
        there = F.lit(False)
        for n in needles:
            there = there | low.contains(n)
        if label == "leilao.br platform":
            there = there | where.contains(needles[0])
        labels.append(F.when(there, label))
        signals.append(F.when(there, signal))
    said = F.lit(False)
    for n in MENTION[1]:
        said = said | low.contains(n)
    signals += [F.when(said, MENTION[0]), *[F.when(by.contains(s), f"server:{s}") for s in SERVERS]]
    return F.array_distinct(F.array_compact(F.array(*labels))), F.slice(F.array_compact(F.array(*signals)), 1, MOST_SIGNALS)

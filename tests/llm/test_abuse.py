import pytest

from pregonero.llm import abuse

HELD_OUT = [
    ("Esse vendedor é um imbecil nojento.", 1), ("Cala essa boca, seu otário.", 1), ("Vai se f0der, seu b0sta.", 1), ("seu i-m-b-e-c-i-l", 1), ("Que m3rda de gente, bando de v e r m e s", 1), ("Esses imigrantes são uma praga, deviam ser expulsos.", 1),
    ("You stupid piece of shit, go die.", 1), ("Hijo de puta, eres un imbécil.", 1), ("Manda nudes, gostosa safada.", 1), ("O telhado precisa de reforma e a garagem é pequena.", 0), ("Obrigado pela ajuda, Marta Ribeiro Campos!", 0), ("P R O M O Ç Ã O de casas no litoral.", 0),
    ("A penhora foi registrada no cartório em maio.", 0), ("The house needs a new roof.", 0), ("La casa tiene tres habitaciones y un patio.", 0), ("Qual o valor do condomínio do lote 8?", 0),
]


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return abuse.fit(spark.read.parquet(f"{sf_dir}/review_example.parquet"))


def test_normalise():
    n = abuse.normalise
    assert n("Você é um І​mb3с1l!!!") == "voce e um imbecil"
    assert n("r e t a r d a d o") == "retardado" and n("m.i.e.r.d.a") == "mierda" and n("60$t0$4") == "gostosa"
    assert n("às 17h15, R$ 1.234,50") == "as 0h0 r 0" and n("otáriooooo") == "otario" and n("m*rda") == "m*rda"
    assert n("") == "" and n("?!") == ""


def test_held_out(model):
    right = sum((model.score(t) >= abuse.ACCEPT) == bool(label) for t, label in HELD_OUT)
    assert right >= len(HELD_OUT) - 2


def test_windows_reach_every_place(model):
    filler = "O imóvel fica perto do comércio. " * 400
    assert model.score(filler) < abuse.ACCEPT
    for text in (filler + "Cala a boca, seu imbecil.", "Cala a boca, seu imbecil. " + filler, filler + "Cala a boca, seu imbecil. " + filler):
        assert model.score(text) >= abuse.ACCEPT


def test_looked_up_sentences_score_alike(model, tmp_path):
    texts = ["Casa boa. Cala a boca, seu verme! Casa boa.", None, "", "Casa boa.", "x" * 50_000, "1d10t4. Vou às 17h15."]
    once = abuse.Filter(model.table, model.bias).scores(texts)
    local = abuse.Filter(model.table, model.bias)
    assert [list(local.scores(texts)), [local.score(t) for t in texts], [abuse.Filter(model.table, model.bias).score(t) for t in texts]] == [list(once)] * 3
    model.save(tmp_path / "filter.npz")
    assert (abuse.Filter.load(tmp_path / "filter.npz").scores(texts) == once).all()


def test_one_long_sentence(model):
    text = "casa boa com vista para o vale " * 60_000
    assert model.score(text) < abuse.ACCEPT <= model.score(text + "cala a boca seu imbecil nojento " + text)


def test_letter_scores_against_plain_loops(model):
    """The sums of a sentence, letter by letter."""
    from itertools import combinations

    s = ".seu verme nojento."
    total = 0.0
    for i in range(len(s) - 1):
        for n, (span, share) in abuse.LENGTHS.items():
            for o in combinations(range(1, span), n - 1):
                end = i + o[-1]
                if end < len(s) and "." not in s[i + 1 : end]:
                    code = 0
                    for k in (0, *o):
                        code = code * abuse.A + abuse.ALPHABET.index(s[i + k])
                    total += share * abuse.DECAY ** o[-1] / abuse._UNIT * float(model.table[((code + n * 7919) * 0x9E3779B1 % (1 << 32)) >> 11])
    assert abs(total / len(s) ** 0.5 + model.bias - model.best_windows([s.strip(".")])[0][0]) < 1e-4


def test_precision_on_held_out_patterns(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/review_example.parquet").select("text", "abusive").collect()
    scored = abuse.held_out([(r.text, int(r.abusive)) for r in rows] + abuse.labelled())
    precision, recall = abuse.rates_at(scored, abuse.ACCEPT)
    assert precision >= 0.93 and recall >= 0.55


def test_documents(spark, model):
    df = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "Cala a boca, seu verme.", 3), (3, "Cala a boca, seu verme.", 3), (4, "Casa boa.", 3), (5, "a" * 100_000, 3)], "doc_id long, text string, score int")
    got = [(r.doc_id, r.abuse_score >= abuse.ACCEPT, r.score) for r in abuse.score_documents(df, model).collect()]
    assert sorted(got) == [(1, False, 3), (2, False, 3), (3, True, 3), (3, True, 3), (4, False, 3), (5, False, 3)]
    assert abuse.score_documents(df.limit(0), model).count() == 0


def test_training_repeats(spark, sf_dir, model):
    again = abuse.fit(spark.read.parquet(f"{sf_dir}/review_example.parquet"))
    assert again.bias == model.bias and (again.table == model.table).all()

"""Language ID, toxicity, personal data and transcripts."""

import random
import re
from itertools import product

import numpy as np
import pytest
from odd import ODD, odd_docs, prose
from pyspark.sql import functions as F

from carepulse.llm import language, pii, toxicity, transcripts, words

LANGS = {
    "en": "the of and to in that is was for it with on as by this are be from thing ing ed er",
    "de": "der die das und ist nicht ein eine mit von auf für sich dem den zu ung heit keit schaft ß ü",
    "fr": "le la les des et est un une dans pour que qui sur pas avec au eau tion ment è é",
    "es": "el la los las y es un una en por que con para del se ción mente ado ía ñ",
}


def language_docs(spark, n, first=0):
    rows = [(first + 4 * k + j, prose(first + 4 * k + j, random.Random(k).randint(4, 80), words), lang)
            for k in range(n) for j, (lang, words) in enumerate(LANGS.items())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def language_model(spark):
    docs = language_docs(spark, 60)
    return language.train(docs.selectExpr("doc_id AS id", "lang AS label"), docs, per_language=50)


def test_families_hold_pairwise_machines(language_model):
    assert language_model["families"] == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert set(language_model["machines"]) == {("f:germanic", "f:romance"), ("de", "en"), ("es", "fr")}
    assert language.family_of("tlh") == "only-tlh"


def test_language_held_out(spark, language_model):
    out = language.predict(language_docs(spark, 40, 10_000), language_model).join(language_docs(spark, 40, 10_000), "doc_id")
    assert out.where("lang_pred = lang").count() >= 0.97 * 160
    assert out.where("score < 0 OR score > 1").count() == 0


def test_unlisted_languages_form_families(spark, monkeypatch):
    rnd, rows = random.Random(3), []
    for lang in range(36):  # six groups of six; a language has words of its group and some of its own
        group = random.Random(lang // 6)
        words = ["".join(group.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(20)]
        words += ["".join(random.Random(100 + lang).choices("abcdefghijklmnopqrstuvwxyz", k=60))[i:i + 5] for i in range(0, 60, 5)]
        rows += [(len(rows) + k, " ".join(rnd.choices(words, k=40)), f"x{lang:02}") for k in range(16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learn = docs.where("doc_id % 4 > 0")
    model = language.train(learn.selectExpr("doc_id AS id", "lang AS label"), learn)
    assert sum(len(m) for m in model["families"].values()) == 36 and len(model["families"]) == 6
    assert len(model["machines"]) <= 300 < 36 * 35 / 2
    held = docs.where("doc_id % 4 = 0")
    assert language.predict(held, model).join(held, "doc_id").where("lang_pred = lang").count() >= 0.95 * held.count()
    by_family = {r["doc_id"]: r for r in language.predict(held, model).collect()}
    monkeypatch.setattr(language, "MODEL_BYTES", 1 << 20)
    with pytest.raises(ValueError):
        language.train(learn.selectExpr("doc_id AS id", "lang AS label"), learn)
    some = {f: m for f, m in model["families"].items() if f in sorted(model["families"])[:2]}  # few machines: all at once
    names = {x for m in some.values() for x in m} | {f"f:{f}" for f in some}
    few = {"families": some, "machines": {k: v for k, v in model["machines"].items() if set(k) <= names}}
    assert len(few["machines"]) <= language.MANY
    mine = [r for r in language.predict(held, few).join(held.select("doc_id", "lang"), "doc_id").collect() if r["lang"] in names]
    assert sum(r["lang_pred"] == by_family[r["doc_id"]]["lang_pred"] for r in mine) >= 0.95 * len(mine) > 0


def test_language_score_depends_on_the_text_alone(spark, language_model):
    docs = language_docs(spark, 5)
    alone = {r["doc_id"]: r["score"] for d in docs.collect()[:4]
             for r in language.predict(spark.createDataFrame([d], docs.schema), language_model).collect()}
    together = {r["doc_id"]: r["score"] for r in language.predict(docs.coalesce(1), language_model).collect()}
    assert all(abs(together[k] - v) < 1e-9 for k, v in alone.items())


def test_language_of_odd_documents(spark, language_model):
    rows = language.predict(odd_docs(spark), language_model).collect()
    assert len(rows) == len(ODD)
    letters = {t for _, t in ODD if t and re.search(r"[^\W\d_]", t)}
    assert sum(r["lang_pred"] == "und" for r in rows) == sum(t not in letters for _, t in ODD)
    assert all((r["lang_pred"] == "und") == (r["score"] == 0) for r in rows)
    kept = language.accepted(odd_docs(spark), language_model)
    assert kept.schema == odd_docs(spark).schema and kept.count() == sum(t in letters for _, t in ODD)
    assert language.predict(odd_docs(spark, []), language_model).count() == 0


def test_language_stage_drops_what_no_machine_can_tell(spark, language_model, monkeypatch):
    rows = [(1, "مرحبا بالعالم هذا نص عربي" * 5, None), (2, "der die das und ist nicht ein eine mit von auf " * 5, None), (3, "123", "de"),
            (4, "the of and to in that is was for it with on " * 5, "kept")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    score = {r["doc_id"]: r["score"] for r in language.predict(docs, language_model).collect()}
    assert 0 < score[1] < score[2]  # letters, but of no language that was learned
    least = (score[1] + score[2]) / 2
    kept = language.accepted(docs, language_model, least_score=least, fill="lang")
    assert {(r["doc_id"], r["lang"]) for r in kept.collect()} == {(2, "de"), (4, "kept")} and kept.columns == docs.columns
    only = language.accepted(docs, language_model, languages=["en"])
    assert {r["doc_id"] for r in only.collect()} & {2, 4} == {4}


def test_sampling_thins_labels_where_they_lie(spark):
    """Two thirds of the rows have one label; what meets in one task is about the limit."""
    labelled = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('l', id % 40) END AS label")
    docs = labelled.selectExpr("id AS doc_id", "concat('text ', id) AS text")
    got = words.sample(labelled, docs, 50, "doc_id", "text").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {label: 50 for label in ["hot", *[f"l{k}" for k in range(40)]]}
    some = words.sample(labelled, docs, {f"l{k}": 5 for k in range(40)} | {"hot": 700}, "doc_id", "text")
    assert some.where("label = 'hot'").count() == 700 and some.count() == 900
    with pytest.raises(ValueError):
        words.sample(spark.range(2000).selectExpr("id", "cast(id AS string) AS label"), docs, 5, "doc_id", "text")
    assert words.sample(labelled.limit(0), docs, 5, "doc_id", "text").count() == 0


def test_few_or_no_languages(spark):
    docs = odd_docs(spark)
    none = language.train(docs.selectExpr("doc_id AS id", "lang AS label").where("false"), docs)
    assert {r["lang_pred"] for r in language.predict(docs, none).collect()} == {"und"}
    one = language.train(docs.selectExpr("doc_id AS id", "lang AS label"), docs)
    assert {(r["lang_pred"], r["score"]) for r in language.predict(docs, one).collect()} == {("und", 0.0), ("en", 1.0)}


def toxic_docs(spark, n, first=0):
    """Every fourth text holds two or three insults of a stem with endings."""
    rows = []
    for k in range(first, first + n):
        words, rnd = prose(k, 60).split(), random.Random(k)
        if k % 4 == 0:
            for _ in range(rnd.randint(2, 3)):
                words[rnd.randrange(len(words))] = "zworx" + rnd.choice(["", "ing", "ed", "or", "ly,"])
        rows.append((k, " ".join(words[:30]) + "\n" + " ".join(words[30:]), int(k % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


@pytest.fixture(scope="module")
def toxicity_model(spark):
    docs = toxic_docs(spark, 400)
    return toxicity.train(docs.selectExpr("doc_id AS id", "toxic AS label"), docs)


def test_toxicity_held_out(spark, toxicity_model):
    docs = toxic_docs(spark, 200, 10_000)
    out = toxicity.score(docs, toxicity_model).join(docs, "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in out) >= 196
    for r in out:
        assert (r["score"] >= 0.5) == (r["predicted"] == 1) and 0 <= r["score"] <= 1
        if r["toxic"] and r["predicted"]:
            spans = [tuple(map(int, s.split(":"))) for s in r["spans"].split(",")]
            assert any("zworx" in r["text"][a:b] for a, b in spans)


def test_toxicity_of_odd_documents(spark, toxicity_model):
    rows = toxicity.score(odd_docs(spark), toxicity_model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows) and not any(r["predicted"] for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["doc_id"], set()).add(r["score"])
    assert len(by_text[12]) == 1 and by_text[1] == by_text[2] == by_text[3]
    assert toxicity.score(odd_docs(spark, []), toxicity_model).count() == 0


def test_toxicity_with_one_label_or_none(spark):
    docs = odd_docs(spark)
    for labels, want in (("1", 1.0), ("0", 0.0), ("CAST(NULL AS INT)", 0.0)):
        model = toxicity.train(docs.selectExpr("doc_id AS id", f"{labels} AS label"), docs)
        assert {r["score"] for r in toxicity.score(docs, model).collect()} == {want}


def test_marginals_equal_sums_over_all_paths():
    rng = np.random.default_rng(0)
    steps, begin = rng.normal(size=4), np.array([0, 1, 6])
    emission = rng.normal(size=9)
    got = toxicity.marginals(emission, begin, steps)
    for a, b in ((0, 1), (1, 6), (6, 9)):
        weight = {path: np.exp(sum(emission[a + i] * s for i, s in enumerate(path)) + sum(steps[2 * x + y] for x, y in zip(path, path[1:])))
                  for path in product((0, 1), repeat=b - a)}
        for i in range(b - a):
            on, off = (sum(w for p, w in weight.items() if p[i] == s) for s in (1, 0))
            assert np.isclose(got[a + i], np.log(on / off))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def base_spans(text):
    valid = {
        "email": lambda v, d: True, "ip": lambda v, d: all(int(p) <= 255 for p in v.split(".")),
        "card": lambda v, d: 12 <= len(d) <= 19 and luhn(d), "phone": lambda v, d: 9 <= len(d) <= 15,
    }
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text)
             if valid[kind](m.group(), re.sub("[^0-9]", "", m.group()))]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def redacted(text, spans):
    out, at = "", 0
    for kind, a, b in (s.split(":") for s in spans.split(",") if s):
        if int(a) >= at:
            out += text[at:int(a)] + f"<{kind.upper()}>"
        at = max(at, int(b))
    return out + text[at:]


def test_spans_and_redaction_against_brute_force(spark):
    rnd = random.Random(11)
    pieces = ["4111111111111111", "4111 1111-1111 1111", "+1 (988) 555-2485", "10.0.0.1", "a.b@c.de", "x@y", "256.1.1.1", "😀", "+1 2", "1",
              "mail:", "(456) 555-2186", "joe [at] ex [dot] com", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8"]
    texts = [" ".join(rnd.choice(pieces) + rnd.choice(["", ".", "-", "1", "a"]) for _ in range(rnd.randint(0, 9))) for _ in range(600)]
    texts += ["".join(rnd.choice("aZ12345..@@--++  ()_%\n😀é") for _ in range(rnd.randint(0, 80))) for _ in range(600)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    model = pii.train(docs)
    found = pii.spans(F.col("text"), model)
    out = docs.select("text", found.alias("s")).select(
        "text", pii.written(F.filter("s", lambda s: s["base"])).alias("base"), pii.written(F.col("s")).alias("all"),
        pii.redacted(F.col("text"), F.col("s")).alias("clean")).collect()
    for r in out:
        assert r["base"] == base_spans(r["text"])
        assert set(r["base"].split(",")) - {""} <= set(r["all"].split(","))
        assert r["clean"] == redacted(r["text"], r["all"])
    assert model.reliabilities["checksum"]["true+1"] > model.reliabilities["checksum"]["false+1"]


def test_many_matches_in_one_text(spark):
    text = "1.2.3.4 a@b.cd " * 3000
    model = pii.train(spark.createDataFrame([("none",)], "text string"))
    row = spark.createDataFrame([(text,)], "text string").select(pii.written(pii.spans(F.col("text"), model)).alias("s")).first()
    assert row["s"] == base_spans(text)


def test_pii_of_odd_documents(spark):
    docs = odd_docs(spark)
    out = pii.find(docs)
    assert out.count() == len(ODD) and out.where("size(spans) > 0").count() == 0
    kept = pii.redact(docs)
    assert kept.schema == docs.schema and sorted(kept.collect(), key=repr) == sorted(docs.collect(), key=repr)
    assert pii.redact(odd_docs(spark, [])).count() == 0


def test_pii_runs_no_python(spark):
    plan = pii.redact(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def turn(k, role):
    return prose(k, 8, "hello please can you show tell me how this works now") + ("?" if role == "user" else ".\n" + prose(k + 1, 12))


def test_transcripts(spark):
    rows, truth = [], {}
    for c in range(60):
        lines = []
        for t in range(6):
            role = ("user", "assistant")[t % 2]
            mark = "" if (c * 7 + t) % 9 == 4 else {"user": "User: ", "assistant": "Assistant: "}[role]
            text = mark + turn(100 * c + t, role)
            rows.append((c, t, role, text))
            lines += [role] * (text.count("\n") + 1)
        truth[c] = lines
    df = spark.createDataFrame(rows, "conv long, pos int, role string, text string").repartition(7)
    out = transcripts.parse(df, "conv", "pos", "text", "role", F.col("conv") < 40).orderBy("id", "first_line").collect()
    got, rendered = {}, {}
    for r in out:
        assert r["first_line"] == len(got.setdefault(r["id"], []))
        got[r["id"]] += [r["role"]] * r["n_lines"]
        rendered[r["id"]] = rendered.get(r["id"], "") + r["rendered"]
    held = [(a, b) for c in range(40, 60) for a, b in zip(truth[c], got[c], strict=True)]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    for text in rendered.values():
        assert re.fullmatch(r"(?s)(<\|im_start\|>(user|assistant|system|other)\n.*?<\|im_end\|>\n)+", text) and "User:" not in text


def test_pieces_of_a_transcript_give_the_whole_path(spark):
    """States settled at partition borders are those of Viterbi over the whole transcript."""
    rows = [(1, k, ("user", "assistant")[k // 3 % 2], ("User: " if k % 6 == 0 else "AI: " if k % 6 == 3 and k % 4 else "") + prose(k, 6)) for k in range(300)]
    rows += [(0, 0, "user", "User: hi"), (2, 0, "assistant", None)]
    df = spark.createDataFrame(rows, "conv long, pos int, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    stored = transcripts._sorted(df, "conv", "pos", "text", transcripts.role_number(F.col("role")), F.lit(True))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert stored.where("id = 1").select("part").distinct().count() > 1
    model = transcripts.train(stored)
    lines = [r["text"] for r in stored.where("id = 1").orderBy("part", "k").collect()]
    want = transcripts.viterbi(model, [transcripts.code(x) for x in lines], transcripts.STATES)
    states = []
    for r in transcripts.turns(stored, model).where("id = 1").orderBy("first_line").collect():
        role = 2 * transcripts.ROLES.index(r["role"])
        states += [role + (not r["begins"])] + [role + 1] * (r["n_lines"] - 1)
    assert states == want.tolist()


def test_odd_transcripts(spark):
    out = transcripts.parse(odd_docs(spark).withColumn("pos", F.lit(0)), "doc_id", "pos", "text", "lang", F.lit(True))
    assert out.agg(F.sum("n_lines")).first()[0] == sum((t or "").count("\n") + 1 for _, t in ODD)
    assert transcripts.parse(odd_docs(spark, []).withColumn("pos", F.lit(0)), "doc_id", "pos", "text").count() == 0

"""Quality and language decisions on held-out labels and odd rows."""

from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from gaugeworks.llm import language, quality
from gaugeworks.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


@needs_tables
def test_quality_against_labels(spark):
    found = QUERIES["op7_quality"](spark, FOLDER).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas().set_index("doc_id").join(found)
    good = labels["quality"] == 1
    assert labels["keep"][good].mean() >= 0.99
    assert (~labels["keep"][~good]).mean() >= 0.9


def test_label_model_finds_the_classes():
    """Labellers that find defects, and signs of good form that most documents show."""
    rnd = np.random.default_rng(4)
    good = rnd.random(20_000) < 0.85
    columns = [-(rnd.random(len(good)) < np.where(good, wrong, right)).astype(int) for right, wrong in ((0.6, 0.002), (0.5, 0.005), (0.7, 0.003))]
    columns += [(rnd.random(len(good)) < np.where(good, right, 0.4)).astype(int) for right in (0.95, 0.9, 0.85)]
    votes = np.stack(columns, axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_labels(patterns, counts)
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.97
    assert abs(model.good - 0.85) < 0.05


def test_quality_of_odd_rows(odd, empty):
    found = quality.quality(odd).collect()
    assert len(found) == odd.count()
    by_id = {r["doc_id"]: r for r in found}
    assert not by_id[4]["keep"] and not by_id[5]["keep"] and not by_id[6]["keep"]
    assert by_id[0]["score"] == by_id[1]["score"] == by_id[None]["score"]
    assert quality.quality(empty).count() == 0


CLEAN = {
    "en": "the river of stone and a house in the garden that was built for many people with great care from old wood by hand",
    "pl": "rzeka płynie przez miasto gdzie ludzie mieszkają spokojnie oraz pracują każdego dnia wśród zielonych drzew pod niebem",
    "fi": "joki virtaa kaupungin läpi missä ihmiset asuvat rauhassa ja tekevät työtä joka päivä vihreiden puiden alla yhdessä",
    "ru": "река течёт через город где люди живут спокойно и работают каждый день среди зелёных деревьев под высоким небом",
    "hi": "नदी शहर के बीच से बहती है जहाँ लोग शांति से रहते हैं और हर दिन पेड़ों के नीचे काम करते हैं",
    "zh": "这条河流穿过古老的城市，人们在这里安静地生活。 每天早上大家都在绿色的树下工作和学习， 晚上回到家里和家人一起吃饭聊天。 孩子们在学校里学习新的知识和技能，",
    "ja": "この川は古い街を流れていて、人々は静かに暮らしています。 毎朝みんな緑の木の下で働いて勉強します、 夜は家に帰って家族と一緒に食事をします。",
    "th": "แม่น้ำไหลผ่านเมืองเก่าที่ผู้คนอาศัยอยู่อย่างสงบสุข ทุกเช้าทุกคนทำงานและเรียนหนังสือใต้ต้นไม้สีเขียว ตอนเย็นกลับบ้านไปกินข้าวกับครอบครัว",
}


def _clean_texts(rnd, count):
    for words in CLEAN.values():
        for _ in range(count):
            yield ". ".join(" ".join(rnd.permutation(words.split())).capitalize() for _ in range(5)) + "."


def test_clean_texts_in_other_languages(spark, odd):
    rnd = np.random.default_rng(9)
    clean = list(_clean_texts(rnd, 25))
    for text, words in zip(clean, quality.word_hashes(clean), strict=True):
        assert min(quality.votes(text, words)) == quality.NONE
    junk = [" ".join(rnd.choice(["BUY", "NOW!!!", "|", "$$$", "@@", "click", "|"], 60)) for _ in range(20)] + ["spam " * (40 + i) for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(clean + junk)), "doc_id long, text string")
    found = {r["doc_id"]: r["keep"] for r in quality.quality(docs).collect()}
    assert all(found[i] for i in range(len(clean)))
    assert not any(found[len(clean) + i] for i in range(len(junk)))


def test_odds_follow_the_counts():
    """A bad vote that good documents get as often as bad ones does not outweigh their signs of good form."""
    rnd = np.random.default_rng(5)
    good = rnd.random(20_000) < 0.85
    columns = [-(rnd.random(len(good)) < np.where(good, wrong, right)).astype(int) for right, wrong in ((0.2, 0.2), (0.2, 0.2), (0.8, 0.002), (0.7, 0.003))]
    columns += [(rnd.random(len(good)) < np.where(good, 0.95, 0.1)).astype(int) for _ in range(2)]
    votes = np.stack(columns, axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.fit_labels(patterns, counts)
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.97


@needs_tables
def test_language_of_pages(spark):
    """Pages are written in the language that their path names."""
    found = QUERIES["op10_language"](spark, FOLDER).toPandas().set_index("page_id")
    urls = spark.read.parquet(f"{FOLDER}/pages.parquet").toPandas().set_index("page_id")["url"]
    named = urls.str.extract(r"://[^/]+/([a-z]{2})/")[0]
    assert len(found) == len(urls)
    assert (found["lang"] == named)[named.notna()].mean() >= 0.99
    assert (found["text_lang"] == named)[named.notna()].mean() >= 0.97


def _evidence(spark, rows):
    return spark.createDataFrame(rows, "id long, text string, declared string, suffix string, domain string, host string, logs string, p double")


def test_evidence_decides_where_text_is_silent(spark, odd):
    training = [("the cat sat on the mat and the dog ran to the house", "en")] * 30 + [("le chat est sur la table et le chien va dans la maison", "fr")] * 30
    model = language.fit_text(spark.createDataFrame(training, "text string, lang string"))
    rows = [(i, training[0][0], "en", None, "example.com", "www.example.com", "", 0.0) for i in range(20)]
    rows += [(100 + i, training[40][0], "fr-FR", "fr", "exemple.fr", "www.exemple.fr", "", 0.0) for i in range(20)]
    rows += [(200, None, "fr", "fr", "exemple.fr", "www.exemple.fr", "", 0.0), (201, "", None, None, None, None, "", 0.0), (202, "12345", None, None, "exemple.fr", "blog.exemple.fr", "", 0.0)]
    rows += [(203, "zqx wvk jjq xzw qqv kzj wqx vvk zzq jkx qwz", None, None, None, None, "", 0.0), (None, "the dog and the cat", "xx", "zz", "a.b", "a.b", "", 0.0)]
    found = {r["id"]: r for r in language.identify(_evidence(spark, rows), model).collect()}
    assert len(found) == len(rows)
    assert {found[i]["lang"] for i in range(20)} == {"en"} and {found[100 + i]["lang"] for i in range(20)} == {"fr"}
    assert found[200]["lang"] == "fr" and found[202]["lang"] == "fr"
    assert found[203]["lang"] == "und" and found[None]["lang"] == "en"
    assert language.identify(_evidence(spark, []), model).count() == 0


def test_every_labelled_language_has_a_model(spark, odd):
    """Forty languages, the last ones with the fewest documents, and the pipeline's stage over them."""
    rnd = np.random.default_rng(8)
    training = []
    for i in range(40):
        words = ["".join(rnd.choice(list("abcdefghijklmnopqrstuvwxyz"), 5)) for _ in range(20)]
        name = chr(97 + i // 26) + chr(97 + i % 26)
        training += [(j, " ".join(rnd.choice(words, 25)), name, "s") for j in range(50 - i)]
    docs = spark.createDataFrame(training, "doc_id long, text string, lang string, source string")
    model = language.fit_text(docs)
    assert len(model.languages) == 41
    rows = [(i, text, None, None, None, None, "", 0.0) for i, (_, text, _, _) in enumerate(training)]
    found = {r["id"]: r["lang"] for r in language.identify(_evidence(spark, rows), model).collect()}
    assert [found[i] for i in range(len(training))] == [t[2] for t in training]
    assert corpus_pipeline.language_stage(spark, docs, "").count() == len(training)


def test_no_labelled_documents(spark, odd):
    model = language.fit_text(spark.createDataFrame([], "text string, lang string"))
    rows = [(1, "some text", "en", None, None, None, "", 0.0)]
    assert language.identify(_evidence(spark, rows), model).first()["lang"] == "und"


def test_page_evidence(spark):
    rows = [
        (1, "https://blog.example.fr/de/1?x=2", '<!DOCTYPE html><HTML class="a" lang="fr-CA"><script>var t="</p>";</script><style>p{}</style><p>Hello &amp; bye<!-- ad --></p>'),
        (2, None, None),
        (3, "not a url", "<p>plain"),
    ]
    found = {r["id"]: r for r in language.page_evidence(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1]["text"].split() == ["Hello", "bye"]
    assert (found[1]["declared"], found[1]["suffix"], found[1]["domain"], found[1]["host"]) == ("fr-CA", "de", "example.fr", "blog.example.fr")
    assert found[2]["text"] is None and found[3]["text"].split() == ["plain"]

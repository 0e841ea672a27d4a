"""The training sample of language ID on skewed tables."""

from pyspark.sql import functions as F

from clickloom.llm import language_id


def test_copies_do_not_displace_the_other_texts_of_a_language(shipped, monkeypatch):
    words = {"fr": "la le les des une que", "en": "the of and with that", "de": "der die und mit das"}
    own = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    each = shipped.range(30).crossJoin(shipped.createDataFrame([(k,) for k in words], "lang string"))
    each = each.select(F.concat(F.repeat(own[F.col("lang")], 20), F.col("id").cast("string")).alias("text"), "lang")
    copies = shipped.range(3_000_000).select(F.lit("la le les" * 9).alias("text"), F.lit("fr").alias("lang"))
    given = []
    train = language_id.train
    monkeypatch.setattr(language_id, "train", lambda *pair: given.append(pair) or train(*pair))
    net = language_id.fit(each.union(copies))
    assert net.languages == ["de", "en", "fr"]
    assert {k: given[0][1].count(k) for k in words} == {"fr": 31, "en": 30, "de": 30}

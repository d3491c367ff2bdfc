import zlib

from pyspark.sql import functions as F

from helpers import STRANGE, documents, sentence
from stowage.llm import language_id as L
from stowage.llm.queries import op6_language


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op6_language(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    tried = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 3 == 1]
    assert all(rows[d.doc_id].held_out == (d in tried) for d in docs)
    assert sum(rows[d.doc_id].lang_pred == d.lang for d in tried) >= 0.97 * len(tried)


def test_strange_texts(spark):
    found = {"aa": b"river stone quiet " * 20, "bb": b"fleuve pierre calme " * 20}
    docs = documents(spark, STRANGE + [(20, "12 34"), (21, "Fleuve! PIERRE, calme"), (22, "zq")]).withColumnRenamed("node", "score")
    rows = L.languages(docs, found).collect()
    assert len(rows) == len(STRANGE) + 3
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_best == "und" and by[i].score == 0 and not by[i].accepted for i in (2, 3, 4, 6, 20))
    assert by[21].lang_best == "bb" and by[21].accepted and all(0 <= r.score <= 1 for r in rows)
    assert by[22].lang_best == "aa" and not by[22].accepted  # a tie


def test_like_plain_compression(spark):
    """Sizes by the codec itself, of the letters cut out and lower-cased here."""
    import regex
    import zstandard

    found = {"aa": sentence(1, 3000).encode(), "bb": sentence(2, 3000)[::-1].encode(), "cc": "le ruisseau dort près du moulin à vent".encode() * 50}
    rows = STRANGE + [(30 + k, sentence(k, 40)[:: 1 if k % 2 else -1]) for k in range(12)] + [(50, "Près du MOULIN, le vent dort: 12 ruisseaux?")]

    def size(text, content):
        data = "".join(c if c.isalpha() else " " for c in text)
        data = regex.sub(" +", " ", data).lower().encode()
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        codec = zstandard.ZstdCompressor(compression_params=zstandard.ZstdCompressionParameters(**L.SETTINGS), dict_data=held)
        return sum(len(codec.compress(data[k:k + L.PART])) for k in range(0, len(data), L.PART))

    got = {(r.doc_id, r.lang_best, r.score) for r in L.languages(documents(spark, rows), found).collect()}
    for key, text in rows:
        if text and any(c.isalpha() for c in text):
            sizes = sorted((size(text, content), k, name) for k, (name, content) in enumerate(found.items()))
            assert (key, sizes[0][2], 1 - sizes[0][0] / sizes[1][0]) in got
        else:
            assert (key, "und", 0.0) in got


def test_nothing_learned(spark):
    docs = documents(spark, STRANGE)
    assert L.dictionaries(docs.withColumn("lang", F.lit(None).cast("string"))) == {}
    assert {r.lang_best for r in L.languages(docs, {}).collect()} == {"und"}
    assert L.languages(documents(spark, []), {"aa": b"x"}).collect() == []


def test_one_language(spark):
    found = L.dictionaries(documents(spark, [(1, sentence(1, 400)), (2, None), (3, "5"), (4, sentence(1, 400))]))
    assert list(found) == ["en"] and 0 < len(found["en"]) <= L.SAMPLES * (L.SAMPLE_BYTES + 1)
    assert {r.score for r in L.languages(documents(spark, [(1, "any text")]), found).collect()} == {1.0}

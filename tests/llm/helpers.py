"""Small tables with everything that may go wrong in them."""

import random

WORDS = ("river stone quiet market lantern copper winter garden signal harbour velvet engine paper mountain ribbon orchard "
         "thunder candle window bridge feather anchor meadow pocket mirror saddle barrel ladder needle basket").split()


def sentence(seed, words):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "s", "ed", "ing", "er", "est"]) for _ in range(words))


def documents(spark, rows):
    """(doc_id, text) rows with the columns of ``documents`` and some whose names operators use themselves."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, fingerprint string, component_id string, "
              "node string, fp int, start string, ids string, _key string, shard int, accepted string, spans int")
    return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t), "f", "c", "n", 1, "s", "i", "k", 2, "a", 3)
                                  for i, t in rows], schema)


STRANGE = [
    (1, sentence(1, 60)), (2, None), (3, ""), (4, " \n\t "), (5, "word"), (6, "...!?"), (None, sentence(2, 30)),
    (None, None), (7, sentence(3, 1500)), (8, sentence(1, 60)), (8, sentence(1, 60)), (9, "日本語のテキスト Ⅷ ½"),
    (10, "a\nb\nc\na\nb\nc\na\nb\nc"), (11, "x" * 30000), (12, sentence(1, 60) + " more"),
]

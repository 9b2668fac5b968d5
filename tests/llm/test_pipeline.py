"""The whole pipeline on a planted corpus, against the plain rule of what may stay."""

import random

import corpus_pipeline
from tests.llm.data import documents, words
from tests.llm.test_bagminhash import plain_classes
from tests.llm.test_models import ALPHABETS, BAD


def planted(rng):
    """Texts by id, labels, benchmark items, and the ids that each stage has to drop."""
    texts, labels, drop = {}, [], {"language": set(), "toxic": set(), "copies": set(), "leaks": set()}

    def clean(name):
        return words(rng, rng.randint(60, 150), ALPHABETS[name])

    items = {i: words(rng, rng.randint(15, 40), ALPHABETS["aa"]) for i in range(6)}
    for d in range(400):
        name = "aa" if d % 3 else "bb"
        body = clean(name)
        if d % 4 == 1:
            for _ in range(4):
                body[rng.randrange(len(body))] = rng.choice(BAD)
            drop["toxic"].add(d)
        elif d % 20 == 2:
            at = rng.randrange(len(body))
            body[at:at] = items[rng.randrange(6)]
            drop["leaks"].add(d)
        texts[d] = (" ".join(body), name)
        if d % 2:
            labels.append((d, 1, int(d in drop["toxic"])))
    for k, d in enumerate(range(400, 440)):  # copies, exact or with one word changed, of documents that stay
        source = 4 * k + 3 if (4 * k + 3) % 20 != 2 else 4 * k + 7
        body = texts[source][0].split()
        if k % 2:
            body[len(body) // 2] = "zz"
        texts[d] = (" ".join(body), texts[source][1])
    for d in range(440, 446):
        texts[d] = (["", None, "123 456", "?!", " ", "\n"][d - 440], None)
        drop["language"].add(d)
    return texts, labels, items, drop


def test_what_stays(spark, tmp_path):
    texts, labels, items, drop = planted(random.Random(3))
    documents(spark, [(d, t, n) for d, (t, n) in texts.items()]).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    left = {d: t for d, (t, _) in texts.items() if d not in drop["language"] | drop["toxic"]}
    classes = plain_classes(left)
    want = {d for d in left if classes[d] == d and d not in drop["leaks"]}
    assert len(left) - len({classes[d] for d in left}) >= 35  # the copies are found by the plain rule too

    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = {r.doc_id for r in packed}
    assert len(got ^ want) <= 0.02 * len(want), (sorted(got - want), sorted(want - got))
    assert got <= set(left) | drop["toxic"]
    assert all(classes.get(d, d) == d for d in got) and not got & drop["leaks"]
    total = {}
    for r in packed:
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
    assert max(total.values()) <= 2048 and len(total) <= sum(total.values()) / 2048 * 1.05 + 1

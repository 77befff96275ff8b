"""Toxicity, quality and mixing: held-out accuracy and defined edge cases."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossaflow.llm import mixing, quality, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))


def test_toxicity_on_held_out_labels(tables):
    docs, labels = tables
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    caught = got[got.toxic == 1].predicted.mean()
    wrong = got[got.toxic == 0].predicted.mean()
    assert caught >= 0.8 and wrong <= 0.02


def test_group_names_alone_are_not_toxic(spark):
    """Labels in which one group is named in toxic texts only: the plain fit
    learns its name, the regularised one does not."""
    rng = random.Random(5)
    neutral = [f"n{i}" for i in range(200)]
    rows = []
    for i in range(600):
        toxic = i % 3 == 0
        words = rng.choices(neutral, k=12)
        if toxic:
            words += rng.sample(["vile", "filth", "scum"], 1) + (["muslim"] if rng.random() < 0.7 else [])
        elif rng.random() < 0.3:
            words += [rng.choice(["christian", "buddhist", "hindu"])]
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    plain, fair = (toxicity.train(docs, labels, penalty=p) for p in (0.0, toxicity.PENALTY))
    text = "a muslim neighbour came by"
    assert plain.score(text) - plain.score(text.replace("muslim", "hindu")) > 5 * abs(fair.score(text) - fair.score(text.replace("muslim", "hindu")))
    assert fair.score(text) < 0.5 < fair.score("you vile scum")


def test_the_penalty_works_through_the_operator(spark):
    """Tables that name groups: neutral mentions of one that toxic texts name
    are flagged without the penalty and left alone with it."""
    rng, rows, labels = random.Random(8), [], []
    neutral = [f"n{i}" for i in range(100)]
    for i in range(1200):
        toxic = i % 3 == 0
        words = rng.choices(neutral, k=10) + (["muslims"] if toxic and rng.random() < 0.9 else []) + ([rng.choice(["christians", "hindus"])] if not toxic and rng.random() < 0.3 else [])
        if toxic and rng.random() < 0.6:
            words.append(rng.choice(["vile", "filth"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    mentions = [(5000 + i, f"muslims {' '.join(rng.choices(neutral, k=8))}") for i in range(50)]
    docs = spark.createDataFrame(rows + mentions, "doc_id long, text string")
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    flagged = {p: toxicity.toxicity(docs, given, penalty=p).where("doc_id >= 5000").agg(F.sum("predicted")).first()[0] for p in (0.0, toxicity.PENALTY)}
    assert flagged[0.0] > 40 and flagged[toxicity.PENALTY] < 5


def test_labels_of_equal_texts(spark):
    docs = spark.createDataFrame([(1, "same"), (2, "same"), (3, "other"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1), (3, 0)], "doc_id long, toxic int")
    from glossaflow.llm.labelled import labelled_sample

    got = sorted(tuple(r) for r in labelled_sample(docs, labels, "toxic").collect())
    assert got == [(1, "same", 1), (3, "other", 0), (4, "", 1)]


def test_toxicity_of_odd_texts(spark, frame, odd_texts):
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id long, toxic int")
    got = toxicity.toxicity(frame(odd_texts), labels).collect()
    assert len(got) == len(odd_texts) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    none = toxicity.toxicity(frame(odd_texts), labels.limit(0)).collect()
    assert {r["predicted"] for r in none} == {0}
    assert toxicity.toxicity(frame(odd_texts).limit(0), labels).count() == 0


def test_quality_on_held_out_labels(tables):
    docs, labels = tables
    only = ~toxicity.held_out(F.col("doc_id"))
    got = quality.judge(docs, labels, only=only).where(toxicity.held_out(F.col("doc_id"))).join(labels, "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() >= 0.995
    assert got[got.quality == 0].kept.mean() <= 0.05


def test_sparse_sites_lean_on_their_priors(spark):
    rows = [("big", "a", 0.9)] * 300 + [("big", "b", 0.2)] * 300 + [("one", "a", 0.1)] + [(f"h{i}", "a", 0.8 if i % 2 else 0.6) for i in range(40) for _ in range(20)]
    each = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, host string, path string, evidence double")
    got = {(r["host"], r["path"]): r["posterior"] for r in quality.sites(each).collect()}
    mean = float(np.mean([r[2] for r in rows]))
    assert abs(got["big", "a"] - 0.9) < 0.05 and abs(got["big", "b"] - 0.2) < 0.05
    assert 0.1 < got["one", "a"] < mean


def by_hand(rows):
    """Posteriors of (host, path, evidence) rows, group by group."""

    def strength(groups):  # (n, s, prior)
        n, s, prior = (np.array(x, float) for x in zip(*groups, strict=True))
        inside, total = (n * prior * (1 - prior)).sum(), n.sum()
        if len(n) < 2 or not inside:
            return 1e6
        spread = ((n * (s / n - prior) ** 2).sum() - (prior * (1 - prior)).sum()) / max(total - (n**2).sum() / total, 1e-9)
        return min(max(inside / total / max(spread, 1e-9) - 1, 1.0), 1e6)

    share, hosts, paths = float(np.mean([e for _, _, e in rows])), {}, {}
    for h, p, e in rows:
        for table, key in ((hosts, h), (paths, (h, p))):
            n, s = table.get(key, (0, 0.0))
            table[key] = (n + 1, s + e)
    k = strength([(n, s, share) for n, s in hosts.values()])
    top = {h: (s + k * share) / (n + k) for h, (n, s) in hosts.items()}
    k2 = strength([(n, s, top[h]) for (h, _), (n, s) in paths.items()])
    return {key: (s + k2 * top[key[0]]) / (n + k2) for key, (n, s) in paths.items()}


def test_posteriors_equal_brute_force_on_sparse_and_dense_hosts(spark):
    rng = np.random.default_rng(3)
    rows = []
    for h in range(60):
        good = rng.beta(2, 2)
        for p in range(int(rng.integers(1, 5))):
            rows += [(f"h{h}", f"/{p}", float(rng.beta(8 * good + 0.1, 8 * (1 - good) + 0.1))) for _ in range(int(rng.choice([1, 2, 40, 300])))]
    each = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, host string, path string, evidence double")
    got, want = {(r["host"], r["path"]): r["posterior"] for r in quality.sites(each).collect()}, by_hand(rows)
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9
    # Paths of one document are moved from their own mean further than others.
    sizes, own = Counter(r[:2] for r in rows), {}
    for h, p, e in rows:
        own[h, p] = own.get((h, p), 0.0) + e
    moved = {one: np.mean([abs(got[k] - own[k] / n) for k, n in sizes.items() if (n == 1) == one]) for one in (True, False)}
    assert moved[True] > 3 * moved[False]


def test_scores_follow_from_evidence_and_site(spark, tables):
    docs, labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), tables[1]
    # Hosts and paths of very unequal size, from addresses.
    url = F.when(F.col("doc_id") % 3 == 0, "http://Big.org/a/x").when(F.col("doc_id") % 3 == 1, F.concat(F.lit("https://h"), (F.col("doc_id") % 40).cast("string"), F.lit(".net/b?q"))).otherwise(F.concat(F.lit("http://big.org/"), F.col("lang"), F.lit("/y")))
    docs = docs.withColumn("url", url)
    got = quality.judge(docs, labels, url_col="url").toPandas().set_index("doc_id")
    sites = {r["doc_id"]: (r["h"], r["p"]) for r in docs.select("doc_id", *(c.alias(n) for c, n in zip(quality.site_of(F.col("url")), "hp", strict=True))).collect()}
    assert {s for s in sites.values() if s[0] == "big.org"} == {("big.org", "/a")} | {("big.org", f"/{x}") for x in docs.where("doc_id % 3 = 2").toPandas().lang.unique()}
    posterior = by_hand([(*sites[i], e) for i, e in got.evidence.items()])
    _, prior = quality.fit(docs, labels)
    odds = lambda p: np.log(p / (1 - p))
    for i, r in got.iterrows():
        site = posterior[sites[i]]
        score = 1 / (1 + np.exp(-(odds(r.evidence) - odds(prior) + odds(min(max(site, 0.001), 0.999)))))
        assert abs(r.site - site) < 1e-9 and abs(r.score - score) < 1e-9 and r.kept == (r.score >= quality.THRESHOLD)


def test_rows_are_rejected_not_ids(spark, monkeypatch):
    bad, good = "BUY NOW !!! $$$ ### " * 9, "a quiet text of plain words that reads well enough to stay where it is " * 3
    rows = [(1, good), (2, bad), (2, good), (None, bad), (None, good), (3, bad), (3, bad)]
    labels = spark.createDataFrame([(10 + i, i % 2) for i in range(40)], "doc_id long, quality int")
    taught = spark.createDataFrame([(10 + i, (good if i % 2 else bad) + f" w{i}") for i in range(40)], "doc_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(taught).withColumns({"source": F.lit("s"), "lang": F.lit("en"), "doc": F.lit("mine"), "id": F.lit(7), "text_hash": F.lit("x")})
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect() if r["doc_id"] is None or r["doc_id"] < 10) == sorted([("1", good), ("2", good), ("None", good)])


def test_quality_of_odd_texts(spark, frame, odd_texts):
    labels = spark.createDataFrame([(i, int(i != 5)) for i in range(9)], "doc_id long, quality int")
    docs = frame(odd_texts).withColumn("source", F.when(F.col("doc_id") == 1, None).otherwise(F.col("source")))
    got = quality.judge(docs, labels).collect()
    assert len(got) == len(odd_texts) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["kept"] for r in quality.judge(docs, labels.limit(0)).collect()} == {True}
    assert quality.judge(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_marginals_are_met(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice(["en", "en", "fr"]), rng.choice("aaab"), rng.choice(["t", "u"])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, about string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.6, "fr": 0.4}, "topic": {"t": 0.3, "u": 0.7}}
    got = mixing.mix(docs, targets, topic_col="about", share=0.2).toPandas()
    mass = got.tokens * got.probability
    assert abs(mass.sum() / got.tokens.sum() - 0.2) < 0.01
    for dim, shares in targets.items():
        for value, share in shares.items():
            assert abs(mass[got[dim] == value].sum() / mass.sum() - share) < 0.01
            kept = got[got.kept]
            assert abs(kept.tokens[kept[dim] == value].sum() / kept.tokens.sum() - share) < 0.06


@pytest.mark.parametrize("least", [1e-3, 1e-6, 1e-9])
def test_calibration_is_exact_for_skewed_targets(spark, least):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice(["en", "en", "fr"]), rng.choice("aaab"), rng.choice(["t", "u"])) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, about string")
    targets = {"source": {"a": 1 - least, "b": least}, "topic": {"t": 0.4, "u": 0.6}}
    got = mixing.mix(docs, targets, topic_col="about", share=0.2).toPandas()
    mass = got.tokens * got.probability
    assert abs(mass.sum() / got.tokens.sum() - 0.2) < 1e-6
    for dim, shares in targets.items():
        for value, share in shares.items():
            assert abs(mass[got[dim] == value].sum() / mass.sum() / share - 1) < 1e-6
    picked = mixing.sample(docs, targets, topic_col="about", share=0.2)
    assert sorted(r["doc_id"] for r in picked.collect()) == sorted(got[got.kept].doc_id)
    # More than there is: all that has a target is kept.
    assert mixing.mix(docs, {"source": {"a": 1.0}}, share=0.9).where("source = 'a' and not kept").count() == 0


def test_mixing_keeps_names_that_clash(spark):
    names = ["_source", "_lang", "_topic", "_p", "topic", "tokens", "probability", "kept", "doc", "id"]
    docs = spark.createDataFrame([(i, "a b c", "s", "en", *([f"mine{i}"] * len(names))) for i in range(30)], ["doc_id", "text", "source", "lang", *names])
    out = mixing.sample(docs, share=1.0)
    assert out.columns == docs.columns and out.count() == 30
    assert all([r[c] for c in names] == [f"mine{r['doc_id']}"] * len(names) for r in out.collect())


def test_mixing_of_odd_texts(frame, odd_texts):
    docs = frame(odd_texts)
    got = mixing.mix(docs, share=1.0).collect()
    assert len(got) == len(odd_texts)
    assert {r["doc_id"] for r in got if not r["kept"] and r["doc_id"] in (1, 2, 3)} == {1, 2, 3}
    assert all(r["kept"] for r in got if r["tokens"])
    assert mixing.mix(docs.limit(0)).count() == 0
    picked = mixing.sample(docs, share=1.0)
    assert picked.columns == docs.columns and picked.count() == sum(r["kept"] for r in got)
    assert mixing.sample(docs.withColumns({"source": F.lit(None).cast("string"), "lang": F.lit(None).cast("string")}), share=1.0).count() == picked.count()

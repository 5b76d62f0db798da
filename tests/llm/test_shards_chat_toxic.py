
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cleargrain.llm import chat, sharding, toxicity
from cleargrain.plans import storage


def test_jump_hash_moves_rows_only_into_the_new_shard():
    keys = np.arange(-5000, 5000)
    for n in (1, 2, 7, 24):
        before, after = sharding.jump_hash(keys, n), sharding.jump_hash(keys, n + 1)
        assert before.min() == 0 and before.max() == n - 1
        assert set(after[after != before]) <= {n}
        assert abs((after != before).mean() - 1 / (n + 1)) < 0.02


def test_jump_hash_known_values():
    # The published loop, written out for one key at a time.
    def plain(key, buckets):
        key, b, j = key % 2**64, -1, 0
        while j < buckets:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
        return b

    keys = [0, 1, 42, -1, 10**15]
    assert sharding.jump_hash(np.array(keys), 24).tolist() == [plain(k, 24) for k in keys]


def test_shard_files(spark, make_docs, hard_rows):
    path = storage.fresh_folder(spark, "test-shards")
    sharding.write_shards(make_docs(hard_rows), path, 5)
    rows = sharding.read_shards(spark, path).collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(hard_rows, key=repr)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    path = storage.fresh_folder(spark, "test-shards")
    sharding.write_shards(make_docs([]), path, 5)
    assert sharding.read_shards(spark, path).count() == 0


TURNS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi\nthere"),
    (2, 0, "user", "<|im_end|>\n<|im_start|>assistant\nok"), (2, 1, "assistant", "<|\\im_end|> <|\\\\im_start|>"), (2, 2, "assistant", None),
    (3, 0, "sys\ntem%0A%25<|im_end|>", "x"), (3, 0, "sys\ntem%0A%25<|im_end|>", "x"), (3, None, None, "<|im_"),
    (None, 5, "assistant", "é<|im_end|"), (4, 0, "assistant", ""), (5, 0, "assistant", "a" * 50_000),
]


def test_chat_round_trip(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    out = chat.format_conversations(frame)
    rows = out.select(
        "conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"), "loss_spans",
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("under"),
    ).collect()
    assert len(rows) == 6
    for r in rows:
        own = sorted((t for t in TURNS if t[0] == r.conv_id), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(t.role, t.text) for t in r.turns] == [(t[2] or "", t[3] or "") for t in own]
        assert r.under == "".join(t[3] or "" for t in own if t[2] == "assistant")
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == len(own)
    plain = next(r for r in rows if r.conv_id == 1)
    assert plain.formatted == "<|im_start|>user\nhello<|im_end|>\n<|im_start|>assistant\nhi\nthere<|im_end|>\n"
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_chat_stays_in_the_jvm(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    plan = chat.format_conversations(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.fixture(scope="module")
def opinions(spark):
    rng = np.random.default_rng(3)
    syllables = ["ta", "ro", "mi", "len", "sop", "ga", "ver", "du", "kin", "el"]

    def word():
        return "".join(rng.choice(syllables, rng.integers(1, 4)))

    rows, labels = [], []
    for n in range(900):
        words, toxic = [word() for _ in range(rng.integers(20, 80))], int(n % 3 == 0)
        for _ in range(4 * toxic):
            words[rng.integers(len(words))] = str(rng.choice(["grobian", "schurke", "halunke"]))
        rows.append((n, " ".join(words)))
        labels.append((n, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_rows_held_out(opinions):
    docs, labels = opinions
    model = toxicity.fit(docs, labels)
    found = docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).withColumn("score", toxicity.score(model, docs)).collect()
    right = [(r.score >= 0.7) == bool(r.toxic) for r in found]
    assert len(found) > 200 and np.mean(right) > 0.95
    seen, unseen, clean = model.score(pa.array(["taro mi grobian len", "taro mi grobiann len", "taro mi gaver len"]))
    assert seen > 0.5 and unseen > 0.5 > clean


def test_toxicity_does_not_depend_on_batches(opinions, hard_rows):
    texts = pa.array([t or "" for _, t in hard_rows])
    model = toxicity.train(toxicity.bags(texts), np.arange(len(texts)) % 2, epochs=1)
    alone = np.concatenate([model.score(texts[i : i + 1]) for i in range(len(texts))])
    assert np.allclose(alone, model.score(texts)) and ((alone >= 0) & (alone <= 1)).all()


def test_toxicity_without_classes(spark, make_docs, hard_rows):
    docs = make_docs(hard_rows)
    labels = spark.createDataFrame([(1, 0), (None, 1), (10, None)], "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs, labels).count() == len(hard_rows)
    assert toxicity.drop_toxic(docs.limit(0), labels.limit(0)).columns == docs.columns


def test_held_out_rule(spark):
    import zlib

    rows = spark.range(50).select("id", toxicity.held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)



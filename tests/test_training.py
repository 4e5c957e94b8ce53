import json

import pytest
from pyspark.sql import functions as F

from chatlake.operators import conversations as cv
from chatlake.operators import pairs, split
from chatlake.operators.clean import clean
from chatlake.operators.extract import extract
from chatlake.plans.jobs import run_prepare
from chatlake.sources.documents import read_documents
from tests import data

PROMPT = "be brief"


def long_conversation():
    return [data.cleaned_row(n, 1, n - 1, f"m{n}", own=n % 2) for n in range(1, 9)]


def lines_of(examples):
    rows = examples.select("conversation_id", "part", cv.example_line().alias("line"))
    return [json.loads(r.line) for r in rows.orderBy("conversation_id", "part").collect()]


def test_examples(spark):
    rows = [*long_conversation(), data.cleaned_row(20, 2, 0), data.cleaned_row(21, 2, 1)]
    (line,) = lines_of(cv.training_examples(data.cleaned(spark, rows), PROMPT))
    assert list(line) == ["id", "messages"] and line["id"] == "convo_1"
    assert line["messages"][0] == {"role": "system", "content": "be brief"}
    assert [m["content"] for m in line["messages"][1:]] == [f"m{n}" for n in range(1, 9)]
    assert line["messages"][1]["role"] == "assistant" and line["messages"][2]["role"] == "user"


def test_parts_of_a_long_conversation_make_the_whole(spark):
    rows = data.cleaned(spark, [*long_conversation(), data.cleaned_row(20, 2, 0)])
    (whole,) = lines_of(cv.training_examples(rows, PROMPT))
    parts = lines_of(cv.training_examples(rows, PROMPT, part_messages=3))
    assert [p.get("part", 0) for p in parts] == [0, 1, 2]
    assert sum((p["messages"] for p in parts), []) == whole["messages"]
    smaller = lines_of(cv.training_examples(rows, PROMPT, part_messages=2))
    assert sum((p["messages"] for p in smaller), []) == whole["messages"]


def test_restarting_indexes_do_not_lengthen_a_part(spark):
    rows = [data.cleaned_row(10 * batch + n, 1, n, f"{batch}.{n}") for batch in range(5) for n in range(4)]
    parts = lines_of(cv.training_examples(data.cleaned(spark, rows), PROMPT, part_messages=3))
    assert [len(p["messages"]) for p in parts] == [4, 3, 3, 3, 3, 3, 2]  # the first has the system message
    late = [data.cleaned_row(99, 2, 10_000)]
    assert not lines_of(cv.training_examples(data.cleaned(spark, late), PROMPT, part_messages=3))


def test_a_very_long_conversation_is_one_line(spark, tmp_path):
    rows = [data.cleaned_row(n, 1, n, f"m{n}") for n in range(10_001)]
    run_prepare(data.cleaned(spark, rows), str(tmp_path), hot_rows=1000)
    (line,) = [r.value for r in spark.read.text(f"{tmp_path}/examples").collect() if r.value.strip()]
    found = json.loads(line)
    assert found["messages"][0]["role"] == "system"
    assert [m["content"] for m in found["messages"][1:]] == [f"m{n}" for n in range(10_001)]
    assert spark.read.json(f"{tmp_path}/metadata").first().num_examples == 1


def test_colliding_indexes_of_two_batches_interleave(spark):
    rows = [data.cleaned_row(1, 1, 0, "a"), data.cleaned_row(2, 1, 1, "b"),
            data.cleaned_row(3, 1, 0, "c")]
    (line,) = lines_of(cv.training_examples(data.cleaned(spark, rows), PROMPT))
    assert [m["content"] for m in line["messages"][1:]] == ["a", "c", "b"]


def test_lines_of_a_very_long_conversation_are_shared_by_the_tasks(spark, tmp_path):
    rows = [data.cleaned_row(n, 1, n, f"m{n}") for n in range(10_001)]
    rows += [data.cleaned_row(20_000 + n, 2, n, f"short {n}") for n in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_prepare(data.cleaned(spark, rows), str(tmp_path), val_ratio=0.0, part_messages=500)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lines = spark.read.text(f"{tmp_path}/examples").select("value", "_metadata.file_path").collect()
    found = [(json.loads(r.value), r.file_path) for r in lines if r.value.strip()]
    long = sorted((line for line, _ in found if line["id"] == "convo_1"), key=lambda line: line.get("part", 0))
    assert [line.get("part") for line in long] == [None, *range(1, 21)]
    assert [m["role"] == "system" for line in long for m in line["messages"]].index(True) == 0
    assert [len(line["messages"]) for line in long] == [501, *[500] * 19, 1]
    assert [m["content"] for line in long for m in line["messages"]][1:] == [f"m{n}" for n in range(10_001)]
    (short,) = [line for line, _ in found if line["id"] == "convo_2"]
    assert list(short) == ["id", "messages"] and len(short["messages"]) == 501
    files = {}
    for line, file in found:
        files[file] = files.get(file, 0) + len(line["messages"])
    assert len(files) > 2 and max(files.values()) < 0.6 * 10_501


def test_a_line_of_any_length_can_be_asked_for(spark, tmp_path):
    rows = [data.cleaned_row(n, 1, n, f"m{n}") for n in range(1_001)]
    run_prepare(data.cleaned(spark, rows), str(tmp_path), part_messages=None)
    (line,) = [r.value for r in spark.read.text(f"{tmp_path}/examples").collect() if r.value.strip()]
    assert [m["content"] for m in json.loads(line)["messages"][1:]] == [f"m{n}" for n in range(1_001)]


def ids(spark, n):
    return spark.range(n).select(F.format_string("convo_%d", "id").alias("conversation_id"))


@pytest.mark.parametrize("n,ratio", [(10, 0.9), (10, 0.1), (77, 0.1), (0, 0.1), (5, 0.0),
                                     (5, 1.0), (1, 0.1), (3, 1 / 3)])
def test_split_sizes_are_exact_and_follow_the_hash_order(spark, n, ratio):
    frame = ids(spark, n)
    labelled = split.assign_split(frame, frame, ratio, seed=42)
    found = {r.conversation_id: r.split for r in labelled.collect()}
    import hashlib
    ordered = sorted(found, key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    cut = int(n * (1 - ratio))
    assert [found[i] for i in ordered] == ["train"] * cut + ["validation"] * (n - cut)


@pytest.mark.parametrize("digits", [1, 2])
def test_split_does_not_depend_on_the_bucket_size(spark, digits):
    frame = ids(spark, 200)
    boundary = split.first_validation_key(frame, 0.3, 1, bucket_digits=digits)
    labels = frame.withColumn("split", split.split_label(boundary, 1))
    other = split.assign_split(frame, frame, 0.3, 1)
    assert labels.exceptAll(other).count() == 0
    assert labels.filter("split = 'train'").count() == 140


def test_prepare_job(spark, tmp_path, derived):
    cleaned = clean(extract(derived))
    run_prepare(cleaned, str(tmp_path))
    counts = {}
    for side in ("train", "validation"):
        lines = spark.read.text(f"{tmp_path}/examples/split={side}").filter("trim(value) <> ''").collect()
        counts[side] = len(lines)
        assert all(set(json.loads(r.value)) == {"id", "messages"} for r in lines)
    assert counts == {"train": 11, "validation": 2}
    meta = spark.read.json(f"{tmp_path}/metadata").first()
    assert meta.num_training_examples == 11 and meta.num_validation_examples == 2
    assert meta.num_conversations == cv.conversation_sizes(cleaned).count()
    assert meta.created_at


def test_normalize_roles(spark, tmp_path):
    def document(*roles):
        return {"id": "x", "title": "t", "message_count": len(roles),
                "messages": [{"role": r, "content": "c", "has_media": False} for r in roles]}

    documents = [document("friend", "self", "friend"), document("system", "self", "other")]
    path = tmp_path / "all.json"
    path.write_text(json.dumps(documents, indent=2))
    normal = cv.normalize_roles(read_documents(spark, str(path), one_array=True))
    for row in normal.collect():
        assert [m.role for m in row.messages] == ["user", "assistant", "user"]
        assert set(row.messages[0].asDict()) == {"role", "content"}


def test_pairs_of_batches_with_restarting_indexes(spark):
    rows = [data.extracted_row(n, 1, f"m{n}", own=(n + 1) % 2) for n in range(1, 7)]
    batches = [clean(data.extracted(spark, part)) for part in (rows[:3], rows[3:])]
    found = pairs.cleaned_pairs(batches[0].unionByName(batches[1])).collect()
    assert sorted((r.position, r.question, r.reply) for r in found) == [
        (0, "m1", "m2"), (2, "m3", "m4"), (4, "m5", "m6")]

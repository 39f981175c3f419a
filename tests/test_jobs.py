import random

from kinlink.config import BlockingConfig, Paths, PipelineConfig
from kinlink.operators import model
from kinlink.plans import jobs
from kinlink.sources import tables

WORDS = ["acme", "widgets", "zeta", "labs", "orbit", "solar", "green", "delta", "stone", "river", "north", "media", "alpha", "craft", "prime"]


def _write(root):
    rng = random.Random(7)
    lines = {s: ["entity_id\tbusiness_name\tbusiness_address\tcountry"] for s in jobs.SOURCES}
    truth = ["source1_entity_id\tmatched_entity_ids"]
    for i in range(60):
        name, address = " ".join(rng.sample(WORDS, 3)), f"{i + 10} {rng.choice(WORDS)} St"
        lines["s1"].append(f"S1-{i}\t{name} Inc\t{address}\tUS")
        if i % 6:
            lines["s2"].append(f"S2-{i}\t{name} LLC\t{'' if i % 10 == 1 else address}\tus")
            lines["s3"].append(f"S3-{i}\t{name}\t{address}, Ste 1\tUS")
        truth.append(f"S1-{i}\t" + (f"S2-{i},S3-{i}" if i % 6 else ""))
    raw = root / "raw"
    raw.mkdir()
    for s, rows in lines.items():
        (raw / f"train_source{s[1]}.tsv").write_text("\n".join(rows) + "\n")
    (raw / "train_ground_truth.tsv").write_text("\n".join(truth) + "\n")


def test_all_jobs_in_order(spark, tmp_path):
    _write(tmp_path)
    c = PipelineConfig(Paths(f"file://{tmp_path}", "team"), blocking=BlockingConfig(tfidf_top_k=5), model={"max_iter": 3, "min_instances": 2})
    out = {}
    for name in ("profile", "normalize", "block", "audit", "recall", "label", "features", "train", "dev-sample", "experiments", "diagnose"):
        out[name] = jobs.JOBS[name](spark, c)
    assert out["audit"]["passed"] and out["audit"]["candidates_s2"][0]["true_pairs"] > 40
    assert out["recall"]["S1_S2"]["recall"][0]["recall"] > 0.9
    assert out["label"]["S1_S2"][0]["positives"] > 40 and len(out["features"]["features"]) == 28
    assert out["train"]["best_threshold"] and len(out["experiments"]["tradeoff"]) == 21
    assert {r["pair_type"]: r["recall_pct"] for r in out["dev-sample"]["recall"]}["S1_S3"] > 90
    assert out["profile"]["ground_truth"] and out["diagnose"]["text_only"]
    assert tables.read_report(spark, c.paths.stage("reports") + "recall.json").keys() == {"S1_S2", "S1_S3"}


def test_default_weight():
    stats = {"S1_S2": {"imbalance_ratio": 4.0}, "S1_S3": {"imbalance_ratio": 6.0}}
    assert model.default_positive_weight(stats) == 5.0 and model.default_positive_weight(stats, "S1_S3") == 6.0 and model.default_positive_weight({}, "S1_S2") == 5.0

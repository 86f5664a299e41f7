"""License statements with lost words: the scan finds what alignment finds."""

import random

import pyarrow as pa
import pytest

from tidewell.llm import license_scan, words


def edited(text: str, share: float, only_single: bool, seed: int) -> str:
    """The text with a share of its words, at least, replaced: of those that occur once, or of any."""
    r, parts = random.Random(seed), text.split(" ")
    low = [p.lower().strip('.,;:()"') for p in parts]
    can = [i for i, x in enumerate(low) if not only_single or low.count(x) == 1]
    for i in r.sample(can, min(len(can), int(share * len(parts)))):
        parts[i] = f"qq{i}"
    return " ".join(parts)


def coverage(text: str, template: str) -> float:
    a, b = (words.split(pa.array([x]), "alnum_lower").h.tolist() for x in (text, template))
    return len(license_scan.align(a, b)) / len(b)


@pytest.mark.parametrize("only_single", [True, False])
def test_lost_words(spark, only_single):
    """17 % of the words of each template are gone, all of them words that it has once; or others, at random."""
    rows = []
    for k, text in license_scan.TEMPLATES.items():
        for seed, share in enumerate([0.17] * 2 + [0.1, 0.19, 0.25]):
            rows.append((len(rows), k, edited(text, share, only_single, seed)))
    docs = spark.createDataFrame([(i, "lorem ipsum " * 20 + t + " dolor sit" * 20) for i, _, t in rows], "doc_id long, text string")
    got = {r["doc_id"]: {x["license"]: x["coverage"] for x in r["licenses"]} for r in license_scan.scan(docs).collect()}
    found = 0
    for i, k, text in rows:
        if coverage(text, license_scan.TEMPLATES[k]) >= license_scan.MIN_COVERAGE:
            # a template within another, or one of the same words, may take the place of it
            assert got[i], (k, text)
            found += k in got[i]
    assert found > 2 * len(license_scan.TEMPLATES)


def test_whole_templates_alone(spark):
    """Each template by itself, with words of other statements lost, is found with the coverage that alignment gives."""
    for k in ("MIT-text", "BSD-2-Clause", "BSD-3-Clause", "ISC"):
        if k not in license_scan.TEMPLATES:
            continue
        text = edited(license_scan.TEMPLATES[k], 0.17, True, 1)
        share = coverage(text, license_scan.TEMPLATES[k])
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        found = license_scan.scan(docs, templates={k: license_scan.TEMPLATES[k]}).first()["licenses"]
        assert share >= 0.8 and [x["license"] for x in found] == [k] and found[0]["coverage"] >= share - 1e-9

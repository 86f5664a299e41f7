import json

from pyspark.sql import functions as F

from tidewell.sources import json_array, readers, writers


def test_tasks_to_keyframes(spark, tmp_path):
    kf = [{"frame": 10, "x": 10.0, "y": 20.0, "width": 30.0, "height": 40.0, "enabled": True}, {"frame": 12, "x": 20.0, "y": 30.0, "width": 30.0, "height": 40.0}]
    result = [{"type": "videorectangle", "value": {"labels": ["Sockeye"], "framesCount": "30", "sequence": kf}}, {"type": "other", "value": {}}]
    task = {"id": 1, "data": {"video": "s3://b/O-s-d_20250101_000000_M.mp4", "fps": 10}, "annotations": [{"updated_at": "2025-01-01", "result": []}, {"updated_at": "2025-02-01", "result": result}]}
    (tmp_path / "a.json").write_text(json.dumps([task]))
    (tmp_path / "b.json").write_text("{broken")
    t = readers.read_tasks(spark, str(tmp_path))
    assert sorted((r["id"], r["error"] is None) for r in t.collect() if r["id"]) == [(1, True)]
    k = readers.keyframes(t).orderBy("kf_pos").collect()
    assert [(r["video_stem"], r["label"], r["frame"], r["enabled"]) for r in k] == [("O-s-d_20250101_000000_M", "Sockeye", 10, True), ("O-s-d_20250101_000000_M", "Sockeye", 12, None)]


def test_labels_and_manifest(spark, tmp_path):
    d = tmp_path / "labels" / "v"
    d.mkdir(parents=True)
    (d / "frame_000001.txt").write_text("0 0.5 0.5 0.10 0.20\nbad line\n1 0.1 0.1 x 0.2\n")
    (d / "frame_000002.txt").write_text("\n")
    (d / "frame_000003.txt").write_text("")  # of no bytes
    boxes = readers.read_label_files(spark, str(tmp_path / "labels"))
    assert [r["class_id"] for r in boxes.where("frame_idx = 3").collect()] == [None]
    boxes = boxes.where("frame_idx < 3")
    got = sorted((r["frame_idx"], r["class_id"] if r["class_id"] is not None else -1, r["w"] or 0.0) for r in boxes.collect())
    assert got == [(1, 0, 0.1), (1, 1, 0.0), (2, -1, 0.0)]
    text = writers.render_labels(boxes.where("class_id is not null"), boxes, ["video_stem", "frame_idx"])
    out = {r["frame_idx"]: r["text"] for r in text.collect()}
    assert out == {1: "0 0.500000 0.500000 0.100000 0.200000\n1 0.100000 0.100000 0.000000 0.200000\n", 2: ""}
    writers.write_manifest(spark.createDataFrame([("v/frame_2.txt",), ("v/frame_1.txt",)], "relpath string"), str(tmp_path / "m"))
    m = readers.read_manifest(spark, str(tmp_path / "m"), "train")
    assert sorted(r["frame_idx"] for r in m.collect()) == [1, 2]


def test_tables(spark, tmp_path):
    (tmp_path / "c1.csv").write_text("Project,Site,Camera,Filename,Date,Time,Turbidity\nP,S,C,7,2025-06-04,3:17:05,2\nP,S,C,NA,2025-06-04,3:17:05,2\n")
    (tmp_path / "c2.csv").write_text("Project,Site,Camera,Filename,Date,Time,Lighting\nP,S,C,8,2025-06-05,3:17:05,NA\n")
    c = readers.read_conditions(spark, [str(tmp_path / "c1.csv"), str(tmp_path / "c2.csv")])
    got = sorted((r["video_stem"], r["task_id"], tuple(r["conditions"].items())) for r in c.collect())
    assert got == [("P-S-C_20250604_031705_M", "7", (("Turbidity", "2"),)), ("P-S-C_20250605_031705_M", "8", ())]
    (tmp_path / "counts.csv").write_text("filename,l_coho,r_coho\na,2,3\n")
    assert readers.read_counts(spark, str(tmp_path / "counts.csv")).count() == 2
    (tmp_path / "map.yaml").write_text("path: x\nnames:\n  0: Coho\n  1: Pink\nother: 1\n")
    assert readers.read_class_map(spark, str(tmp_path / "map.yaml")) == {"Coho": 0, "Pink": 1}
    (tmp_path / "list.yaml").write_text("names:\n  - Coho\n  - 'Chum'\n")
    assert readers.read_class_map(spark, str(tmp_path / "list.yaml")) == {"Coho": 0, "Chum": 1}


def test_headers_differ(spark, tmp_path):
    """Every reader of CSV files goes by the header of each file, not by position."""
    write = lambda name, text: ((tmp_path / name).parent.mkdir(parents=True, exist_ok=True), (tmp_path / name).write_text(text))
    write("counts/a b.csv", "\ufefffilename,l_coho,r_coho\na,2,3\n")
    write("counts/b.csv", "filename,l_sockeye,r_coho\nb,7,9\n")
    write("counts/c.csv", "filename, r_coho, l_coho\nc,5,4\n")
    got = {(r["filename"], r["direction"], r["species"]): r["n"] for r in readers.read_counts(spark, str(tmp_path / "counts")).collect()}
    assert got == {("a", "l", "coho"): 2, ("a", "r", "coho"): 3, ("b", "l", "sockeye"): 7, ("b", "r", "coho"): 9, ("c", "r", "coho"): 5, ("c", "l", "coho"): 4}
    write("tune/t1/results.csv", "epoch,  fitness, metrics/mAP50(B)\n1, 0.3, 0.5\n")
    write("tune/t2/results.csv", "epoch,metrics/mAP50(B),fitness\n1,0.6,0.2\n")
    got = {r["trial"]: (r["fitness"], r["metrics/mAP50(B)"]) for r in readers.read_trials(spark, str(tmp_path / "tune")).collect()}
    assert got == {"t1": (0.3, 0.5), "t2": (0.2, 0.6)}
    write("net/x/m.csv", "ts,bits,jitter\n60,1.5,2\n")
    write("net/y/m.csv", "time,jitter,bits\n120,3,4.5\nodd,1,1\n")
    got = sorted((r["ts"] is None, r["bits"], r["jitter"]) for r in readers.read_measurements(spark, str(tmp_path / "net"), "m.csv", ["bits", "jitter"]).collect())
    assert got == [(False, 1.5, 2.0), (False, 4.5, 3.0), (True, 1.0, 1.0)]
    write("rev/a.csv", "clip,site,x__total__annotated,y__total__annotated\nk,s1,2,3\nl,s2,1,\n")
    write("rev/b.csv", "y__total__annotated,clip,site\n4,m,s1\n")
    assert sorted(tuple(r) for r in readers.read_reviewed_counts(spark, str(tmp_path / "rev"), "clip").collect()) == [("k", 5), ("l", 1), ("m", 4)]
    assert sorted(r["clip"] for r in readers.read_reviewed_counts(spark, str(tmp_path / "rev"), "clip", "site", ["s1"]).collect()) == ["k", "m"]
    write("lat/aws_us/a.csv", "t,x,ms\n60,1,7\n")
    assert [tuple(r)[1:] for r in readers.read_latency(spark, str(tmp_path / "lat")).collect()] == [("aws", "us", 7.0)]


def test_strict_tasks(spark, tmp_path):
    for name, text in (("a.json", '[{"id": 1}]'), ("b.json", '{"id": 2}'), ("c.json", "[broken"), ("d.json", "7")):
        (tmp_path / name).write_text(text)
    errors = {r["file_path"][-6:]: r["error"] for r in readers.read_tasks(spark, str(tmp_path), strict=True).collect()}
    assert errors == {"a.json": None, "b.json": "no list of tasks", "c.json": "not readable", "d.json": "no list of tasks"}
    assert sorted(r["id"] for r in readers.read_tasks(spark, str(tmp_path)).where("error is null").collect()) == [1, 2]


def test_cvat(spark, tmp_path):
    box = '<box label="Coho" xtl="1" ytl="2" xbr="3.5" ybr="4"><attribute name="__instance_id">9</attribute></box>'
    (tmp_path / "output.xml").write_text(f'<annotations><version>1.1</version><image id="0" name="f0">{box}</image><image id="1" name="f1"></image></annotations>')
    got = sorted(tuple(r)[1:] for r in readers.read_cvat_xml(spark, str(tmp_path)).collect())
    assert got == [(0, "f0", 0, "Coho", 9, 1.0, 2.0, 3.5, 4.0), (1, "f1", None, None, None, None, None, None, None)]


def test_log_order(spark, tmp_path):
    d = tmp_path / "hdd" / "o" / "s" / "d"
    d.mkdir(parents=True)
    lines = [f"2025-06-25 05:21:24,544 - INFO [run.py:61] - m{i}" for i in range(4000)]
    (d / "logs_20250625.log").write_text("\n".join(lines) + "\r\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        logs = readers.read_logs(spark, str(tmp_path))
        assert logs.rdd.getNumPartitions() > 5
        got = [(r["message"], str(r["file_date"])) for r in logs.orderBy("line_no").collect()]
        assert got == [(f"m{i}", "2025-06-25") for i in range(4000)] and logs.select("line_no").distinct().count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_logs(spark, tmp_path):
    d = tmp_path / "hdd" / "org" / "site" / "dev" / "logs"
    d.mkdir(parents=True)
    (d / "a.log").write_text("2025-06-25 05:21:24,544 - INFO [run.py:61] - start\n\nodd\n")
    got = readers.read_logs(spark, str(tmp_path)).collect()
    assert [(r["org"], r["site"], r["device"], r["message"]) for r in got] == [("org", "site", "dev", "start")]


def test_json_sources(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"items": [{"id": f"c{i // 2}/f{i}", "annotations": [{"label_id": 1, "bbox": [0, 0, 2, 4], "attributes": {"track_id": 5} if i else {}}]} for i in range(4)]}))
    r = readers.read_datumaro(spark, str(tmp_path / "d.json")).orderBy("item_pos").collect()
    assert [(x["item_pos"], x["clip"], x["track_id"], x["cx"], x["y2"]) for x in r] == [(1, 1, 5, 1.0, 4.0), (2, 2, 5, 1.0, 4.0), (3, 2, 5, 1.0, 4.0)]
    for name in ("one", "two"):
        (tmp_path / "many").mkdir(exist_ok=True)
        (tmp_path / "many" / f"{name}.json").write_text(json.dumps({"items": [{"id": f"{name}/f{i}", "annotations": [{"label_id": 1, "bbox": [0, 0, 2, 4], "attributes": {"track_id": 5}}]} for i in range(2)]}))
    got = sorted((x["file"][-8:], x["item_pos"], x["clip"]) for x in readers.read_datumaro(spark, str(tmp_path / "many")).collect())
    assert got == [("one.json", 0, 1), ("one.json", 1, 1), ("two.json", 0, 1), ("two.json", 1, 1)]
    (tmp_path / "o.json").write_text(json.dumps({"metadata": [{"name": "f0", "bounding_boxes": {"interested_objects": [{"x": 1, "y": 2, "w": 3, "h": 4}], "noises": []}}]}))
    assert [tuple(x) for x in readers.read_objects(spark, str(tmp_path / "o.json")).collect()] == [(0, "f0", "interested_objects", 0, 1, 2, 3, 4)]


def test_shared_dir_on_a_cluster():
    import pytest

    from tidewell import session

    class Conf:
        def get(self, name, default=None):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_scratch(spark):
    """Tables written for a step are removed with it, its result stays."""
    import os

    from tidewell import session

    with session.scratch(spark) as keep:
        inner = session.materialize(spark.range(5), "inner")
        out = keep(inner.selectExpr("id + 1 id"), "outer")
    where = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    assert out.count() == 5 and os.path.exists(where(out))
    folder = session.shared_dir(spark).removeprefix("file://")
    assert not [f for f in os.listdir(folder) if f.startswith("inner-")]


def test_json_array_by_ranges(spark, tmp_path):
    """Elements of an array are the same however the file is cut: strings with marks and escapes, other arrays, a byte order mark."""
    import json

    odd = ["[", "]", "{,}", "\\", '\\"', '"', ',"items":[', 'x\\"y', "é…", ""]
    items = [{"id": str(i), "s": odd[i % len(odd)], "deep": [[i], {"items": [i, odd[-i % len(odd)]]}]} for i in range(200)]
    for name, value in (("list", items), ("nested", {"x": [1, {"items": [3]}], "items": items, "z": ["]"]})):
        for indent in (None, 2):
            (tmp_path / f"{name}{indent}.json").write_bytes(b"\xef\xbb\xbf \n" + json.dumps(value, indent=indent, ensure_ascii=False).encode())
    for n, text in (("cut", '[{"id": "1"}, {"id"'), ("bad", '[{"id": "1"}, {"id": }]'), ("empty", ""), ("one", '{"id": 7}'), ("none", "[]")):
        (tmp_path / f"{n}.json").write_text(text)
    for size in (97, 5000, 1 << 20):
        rows = json_array.read_json_array(spark, str(tmp_path), "id string, s string", split_bytes=size).collect()
        by = {}
        for r in rows:
            by.setdefault(r["path"].rpartition("/")[2].removesuffix(".json"), []).append((r["item_pos"], r["item"] and (r["item"]["id"], r["item"]["s"]), r["error"]))
        want = [(i, (x["id"], x["s"]), None) for i, x in enumerate(items)]
        assert sorted(by.pop("listNone")) == sorted(by.pop("list2")) == want
        assert by == {"nestedNone": [(None, None, "no list")], "nested2": [(None, None, "no list")], "cut": [(None, None, "not readable")], "bad": [(None, None, "not readable")], "empty": [(None, None, "no list")], "one": [(None, None, "no list")]}
        nested = json_array.read_json_array(spark, str(tmp_path), "id string, s string", "nested*.json", "items", split_bytes=size).collect()
        assert sorted((r["item_pos"], (r["item"]["id"], r["item"]["s"]), r["error"]) for r in nested) == sorted(want * 2)
    tasks = readers.read_tasks(spark, str(tmp_path), glob="one.json").collect()
    assert [(r["id"], r["error"]) for r in tasks] == [(7, None)]
    assert [r["error"] for r in readers.read_tasks(spark, str(tmp_path), strict=True, glob="one.json").collect()] == ["no list of tasks"]


def test_large_json_array_by_tasks(spark, tmp_path):
    """One file is read by several tasks, each about as much as a range."""
    import json

    (tmp_path / "big.json").write_text(json.dumps([{"id": str(i), "s": "x" * (i % 300)} for i in range(20_000)]))
    rows = json_array.array_elements(spark, str(tmp_path), split_bytes=200_000)
    sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.sum(F.length("body")).alias("n")).collect()]
    assert len(sizes) > 8 and max(sizes) < 1_500_000
    assert rows.select("item_pos").distinct().count() == 20_000 and rows.agg(F.max("item_pos")).first()[0] == 19_999


def test_listing(spark, tmp_path):
    from tidewell.sources.listing import list_files

    for name in ("a.txt", "x/b.txt", "x/y/c.txt", "x/_hidden.txt", ".z/d.txt", "x/e 1%.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("12" if "b" in name else "")
    got = sorted((r["path"].removeprefix(f"file:{tmp_path}/"), r["size"]) for r in list_files(spark, str(tmp_path), folders=1).collect())
    assert got == [("a.txt", 0), ("x/b.txt", 2), ("x/e 1%.csv", 0), ("x/y/c.txt", 0)]
    assert [r["size"] for r in list_files(spark, f"file://{tmp_path}/x/b.txt").collect()] == [2]
    images = readers.read_image_listing(spark, str(tmp_path / "x")).collect()
    assert sorted((r["clip"], r["n_images"]) for r in images) == [("x", 2), ("x", 2), ("y", 1)]


def test_documents_in_parts(spark, tmp_path, monkeypatch):
    """A group's items fill as many files as they ask for, none lost or there twice."""
    from tidewell.plans import files

    monkeypatch.setattr(files, "ITEMS", 100)
    path = files._documents(spark.range(1000), F.col("id") % 3, "id", F.struct("id"), str(tmp_path / "d"))
    lists = [[x["id"] for x in json.loads(r["value"])] for r in spark.read.text(path, wholetext=True).collect()]
    assert sorted(i for x in lists for i in x) == list(range(1000))
    assert len(lists) == 30 and max(map(len, lists)) < 100


def test_coco_in_parts(spark):
    """Parts of a file's document hold each image once, with all its annotations."""
    rows = [(f"v{i % 50}", "f", i % 3, 0.0, 0.0, float(i), 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "image string, site string, cls int, x double, y double, w double, h double")
    docs = [json.loads(r["json"]) for r in writers.to_coco(df, "image", "site", "cls", parts=4).collect()]
    assert 1 < len(docs) <= 4
    images = [x["id"] for doc in docs for x in doc["images"]]
    assert len(images) == len(set(images)) == 50
    assert sum(len(doc["annotations"]) for doc in docs) == 200
    assert all({a["image_id"] for a in doc["annotations"]} == {x["id"] for x in doc["images"]} for doc in docs)


def test_datumaro_by_lines(spark, sf_small, monkeypatch):
    """A file is written item by item: each is a line of its own."""
    from tidewell.plans import files

    read, seen = readers.read_datumaro, []
    monkeypatch.setattr(readers, "read_datumaro", lambda s, path: seen.append(path) or read(s, path))
    n = files.datumaro_files(spark, sf_small).count()
    assert spark.read.text(seen[0]).count() == n
    assert spark.read.text(seen[0]).select("_metadata.file_path").distinct().count() == 6


def test_small_files_by_tasks(spark, sf_small, tmp_path, monkeypatch):
    """Tasks that write a file for each row are cut by the number of files; XML files by the number of their records."""
    from tidewell.plans import files

    monkeypatch.setattr(writers, "FILES", 10)
    monkeypatch.setattr(files, "ITEMS", 100)
    seqs = spark.range(100).select(F.col("id").alias("name"), *[F.lit(1).alias(c) for c in ("fps", "length", "w", "h")])
    writers.write_seqinfo(seqs, str(tmp_path / "q"), "name", "fps", "length", "w", "h")
    names = {p.name.split("-")[1] for p in (tmp_path / "q").rglob("part-*")}
    assert len(names) > 5 and readers.read_seqinfo(spark, str(tmp_path / "q"), "*.txt").count() == 100
    path = str(tmp_path / "x")
    monkeypatch.setattr(files, "_folder", lambda s: path)
    files.cvat_files(spark, sf_small).count()
    assert len(list((tmp_path / "x").rglob("part-*"))) >= 15
    path = str(tmp_path / "i")
    n = files.image_listing_files(spark, sf_small).count()
    found = list((tmp_path / "i").rglob("part-*.txt"))
    assert len(found) == n and len({p.name.split("-")[1] for p in found}) > 1

"""Files in and out."""

from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

import numpy as np
import pytest
from conftest import rows

from sheafwork.operators.images import flatten_alpha, flattened, lanczos_weights, resample, resized
from sheafwork.plans import acquire, image_jobs, link_check, progress_report, training_set
from sheafwork.schemas import BUNDLE_2021, BUNDLE_2022
from sheafwork.sinks.checkpoint import append_ids
from sheafwork.sinks.files import with_row_index, write_csv, write_jsonl
from sheafwork.sinks.images import png_bytes
from sheafwork.sinks.store import read_store, write_store
from sheafwork.sources import bundle
from sheafwork.sources.idlist import read_id_set
from sheafwork.sources.images import read_images, scan_report
from sheafwork.sources.listing import list_files, list_flat, resolved
from sheafwork.sources.tsv import MissingColumns, read_catalogue, read_catalogue_strict


def write(path: Path, text: str | bytes) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def text_of(folder: str, suffix: str) -> list[str]:
    return [line for p in sorted(Path(folder).glob(f"part-*{suffix}")) for line in p.read_text().splitlines()]


TSV = "gbifID\ttitle\tidentifier\tcountryCode\n1\tt\thttp://a\tNA\n2\tt\n3\tt\t\tUS\n\tt\thttp://d\tUS\n5\tt\thttp://e\tUS\textra\tmore\nx\tt\thttp://f\tUS\n"


def test_catalogue_keeps_every_row(spark, tmp_path):
    got = rows(read_catalogue(spark, write(tmp_path / "m.txt", TSV)))
    assert got == sorted(
        [(1, "http://a", "NA"), (2, None, None), (3, None, "US"), (None, "http://d", "US"), (5, "http://e", "US"), (None, "http://f", "US")], key=repr
    )


def test_missing_columns(spark, tmp_path):
    path = write(tmp_path / "m.txt", "identifier\tgbifID\nhttp://a\t1\n")
    assert rows(read_catalogue(spark, path)) == [(1, "http://a", None)]
    assert read_catalogue_strict(spark, path).columns == ["gbif_id", "identifier"]
    with pytest.raises(MissingColumns):
        read_catalogue_strict(spark, path, ["gbifID", "countryCode"])


def test_id_list(spark, tmp_path):
    path = write(tmp_path / "ids.txt", " 7 \n\n\t8\t\n7\n007\n   \n")
    assert rows(read_id_set(spark, path)) == [("007",), ("7",), ("8",)]
    assert read_id_set(spark, str(tmp_path / "absent.txt")).count() == 0


def test_append_writes_each_id_once(spark, tmp_path):
    path = str(tmp_path / "list")
    for ids in (["1", "2", "2"], ["2", "3"], ["1"]):
        append_ids(spark.createDataFrame([(i,) for i in ids], "id string"), path)
    assert sorted(text_of(path, ".txt")) == ["1", "2", "3"]


def test_csv_has_an_unnamed_index_and_jsonl_writes_nulls(spark, tmp_path):
    df = spark.createDataFrame([("b", None, 'say "x", y'), ("a", "é/", "z")], "k string, v string, t string")
    write_csv(with_row_index(df, ["k"]), str(tmp_path / "c"), index="row_index")
    assert sorted(text_of(str(tmp_path / "c"), ".csv")) == sorted([",k,v,t", "0,a,é/,z", '1,b,,"say ""x"", y"'])
    write_jsonl(df, str(tmp_path / "j"))
    got = [json.loads(line) for line in text_of(str(tmp_path / "j"), ".json")]
    assert {"k": "b", "v": None, "t": 'say "x", y'} in got and len(got) == 2


def bundle_2022() -> dict:
    return {
        "annotations": [{"image_id": f"{i}", "category_id": i % 3, "institution_id": 1} for i in range(20)],
        "images": [{"image_id": f"{i}", "file_name": f"{i}.jpg"} for i in range(20)] + [{"image_id": "0", "file_name": "last.jpg"}],
        "categories": [{"category_id": c, "species": f"s{c}", "genus": "G", "family": "F", "authors": "x"} for c in range(3)],
        "institutions": [{"institution_id": 1, "collectionCode": "I"}],
    }


def test_bundle_to_written_dataset(spark, tmp_path):
    path = write(tmp_path / "meta.json", json.dumps(bundle_2022(), indent=1))
    star = bundle.star_2022(bundle.read_bundles(spark, path, BUNDLE_2022))
    done = training_set.build(star, 2022)
    training_set.write_dataset(done, str(tmp_path / "out"), 2022)
    parts = {p: [json.loads(x) for x in text_of(str(tmp_path / f"out/{p}_2022.json"), ".json")] for p in ("train", "val")}
    assert (len(parts["train"]), len(parts["val"])) == (16, 4)
    everything = parts["train"] + parts["val"]
    assert {r["image_id"] for r in everything} == {str(i) for i in range(20)}
    zero = next(r for r in everything if r["image_id"] == "0")
    assert zero["filename"] == "last.jpg" and zero["scientificName"] == "F G s0" and zero["scientificNameEncoded"] == 0
    assert list(zero) == ["image_id", "filename", "caption", "scientificName", "family", "genus", "species", "scientificNameEncoded"]
    header = text_of(str(tmp_path / "out/val_2022.csv"), ".csv")[0]
    assert header == ",image_id,filename,caption,scientificName,family,genus,species,scientificNameEncoded"


@pytest.mark.parametrize("lines", [False, True])
def test_the_last_document_wins(spark, tmp_path, lines):
    """Three documents that repeat keys, as files and as lines of one file; annotations get names of their own."""
    documents = []
    for n in range(3):
        one = bundle_2022()
        for category in one["categories"]:
            category["species"] = f"species{n}"
        one["categories"].append(dict(one["categories"][0], species=f"last{n}"))
        documents.append(one)
    folder = tmp_path / "meta"
    folder.mkdir()
    if lines:
        write(folder / "all.json", "\n".join(map(json.dumps, documents)))
    else:
        for n in (2, 0, 1):
            write(folder / f"{n}.json", json.dumps(documents[n], indent=1))
    star = bundle.star_2022(bundle.read_bundles(spark, str(folder), BUNDLE_2022, multi_line=not lines))
    species = {r["category_id"]: r["species"] for r in star["categories"].collect()}
    first = documents[0]["categories"][0]["category_id"]
    assert species == {k: "last2" if k == first else "species2" for k in species}
    ids = [r["id"] for r in star["annotations"].collect()]
    assert len(ids) == len(set(ids)) == 3 * len(documents[0]["annotations"])
    images = {str(a["image_id"]) for a in documents[0]["annotations"]}
    assert images <= set(ids) and {i.split("#")[0] for i in ids} == images


def test_bundle_2021(spark, tmp_path):
    meta = {
        "annotations": [{"id": 5, "category_id": 1, "institution_id": 2, "image_id": 9}],
        "images": [{"id": 5, "file_name": "images/5.jpg"}],
        "categories": [{"id": 1, "name": "Genus species", "family": "F", "order": "O"}],
        "institutions": [{"id": 2, "name": "Garden"}],
    }
    path = write(tmp_path / "meta.json", json.dumps(meta))
    star = bundle.star_2021(bundle.read_bundles(spark, path, BUNDLE_2021))
    row = training_set.build(star, 2021).first()
    assert (row["image_id"], row["filename"], row["genus"], row["species"], row["institution"]) == (5, "5.jpg", "Genus", "species", "Garden")
    assert row["caption"].endswith("collection of institution Garden.")


def test_listing_keeps_empty_files(spark, tmp_path):
    for name, body in (("a/b/1.jpg", b"x" * 3), ("a/b/2.jpg", b""), ("a/c/d/e/3.jpg", b"y"), ("top.txt", b"")):
        write(tmp_path / "store" / name, body)
    base = str(tmp_path / "store")
    assert rows(list_files(spark, base)) == [(f"{base}/a/b/1.jpg", 3), (f"{base}/a/b/2.jpg", 0), (f"{base}/a/c/d/e/3.jpg", 1), (f"{base}/top.txt", 0)]
    assert rows(list_flat(spark, base)) == [(f"{base}/top.txt", 0)]


def test_store_is_partitioned_by_prefixes(spark, tmp_path):
    df = spark.createDataFrame([(1234567, b"a"), (12, b"b"), (1230001, b"c")], "gbif_id bigint, content binary")
    write_store(df, str(tmp_path / "s"))
    assert (tmp_path / "s" / "prefix1=123" / "prefix2=456").is_dir()
    stored = read_store(spark, str(tmp_path / "s"), "gbif_id bigint, content binary, prefix1 string, prefix2 string")
    assert rows(stored.filter("prefix1 = '123'").select("gbif_id", "prefix2")) == [(1230001, "000"), (1234567, "456")]


def pictures() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(0)
    return {n: rng.integers(0, 256, (6, 9, b), dtype=np.uint8) for n, b in (("rgb.png", 3), ("rgba.png", 4), ("grey.png", 1))}


def test_image_scan_and_flatten(spark, tmp_path):
    folder = tmp_path / "with space+plus"
    for name, pixels in pictures().items():
        write(folder / name, png_bytes(pixels))
    write(folder / "bad.png", png_bytes(pictures()["rgb.png"])[:30])
    write(folder / "empty.png", b"")
    images = read_images(spark, str(folder))
    report = {r["path"].rsplit("/", 1)[1]: (r["height"], r["readable"]) for r in scan_report(list_flat(spark, str(folder)), images).collect()}
    assert report == {"rgb.png": (6, True), "rgba.png": (6, True), "grey.png": (6, True), "bad.png": (-1, False), "empty.png": (None, False)}
    for row in flattened(images).collect():
        name = row["origin"].rsplit("/", 1)[1]
        if name == "bad.png":
            assert (row["error"], row["data"]) == ("unreadable", None)
            continue
        expected = flatten_alpha(pictures()[name])
        assert (row["nChannels"], row["mode"]) == (3, 16)
        assert bytes(row["data"]) == expected.tobytes()


def test_flatten_lays_alpha_over_white():
    pixel = np.array([[[10, 20, 30, 0], [10, 20, 30, 255], [0, 0, 0, 128]]], dtype=np.uint8)
    assert flatten_alpha(pixel).tolist() == [[[255, 255, 255], [10, 20, 30], [127, 127, 127]]]


def brute_resample(line: list[int], target: int) -> list[int]:
    """One axis, straight from the definition of the windowed kernel."""
    import math

    def kernel(x):
        if x == 0:
            return 1.0
        return 0.0 if abs(x) >= 3 else 3 * math.sin(math.pi * x) * math.sin(math.pi * x / 3) / (math.pi * x) ** 2

    scale, out = len(line) / target, []
    for t in range(target):
        weights = [kernel((s + 0.5 - (t + 0.5) * scale) / scale) for s in range(len(line))]
        total = sum(w * v for w, v in zip(weights, line)) / sum(weights)
        out.append(min(255, max(0, math.floor(total + 0.5))))
    return out


@pytest.mark.parametrize(("source", "target"), [(9, 4), (16, 5), (31, 30)])
def test_lanczos_against_brute_force(source, target):
    rng = np.random.default_rng(source)
    line = rng.integers(0, 256, source)
    got = resample(line.astype(np.uint8).reshape(1, source, 1), target, 1)
    assert np.abs(got.reshape(-1).astype(int) - brute_resample(line.tolist(), target)).max() <= 1
    assert np.allclose(lanczos_weights(source, target).sum(axis=1), 1)


def test_resize_fits_the_box_and_never_enlarges(spark, tmp_path):
    write(tmp_path / "i" / "a.png", png_bytes(np.full((30, 60, 4), 200, np.uint8)))
    write(tmp_path / "i" / "b.png", png_bytes(np.full((5, 8, 3), 77, np.uint8)))
    got = {r["origin"][-5]: (r["width"], r["height"], set(r["data"])) for r in resized(read_images(spark, str(tmp_path / "i")), 20).collect()}
    assert got["a"][:2] == (20, 10) and got["b"] == (8, 5, {77})
    assert got["a"][2] == {212}


def test_an_image_that_fails_keeps_its_row(spark):
    rows_in = [("ok", 1, 2, 1, 0, bytearray(b"ab")), ("cut", 2, 2, 3, 16, bytearray(b"abc"))]
    df = spark.createDataFrame(rows_in, "origin string, height int, width int, nChannels int, mode int, data binary")
    got = {r["origin"]: (r["data"], r["error"]) for r in flattened(df).collect()}
    assert got["ok"] == (bytearray(b"aaabbb"), None)
    assert got["cut"][0] is None and got["cut"][1].startswith("ValueError")


def test_resize_folder_only_takes_large_files(spark, tmp_path):
    noise = np.random.default_rng(1).integers(0, 256, (900, 1000, 3), dtype=np.uint8)
    write(tmp_path / "f" / "large.png", png_bytes(noise))
    write(tmp_path / "f" / "small.png", png_bytes(noise[:10, :10]))
    write(tmp_path / "f" / "empty.png", b"")
    gates = rows(image_jobs.resize_folder(spark, str(tmp_path / "f"), str(tmp_path / "out"), box=100))
    assert gates == [("resize", 1), ("skip_empty", 1), ("skip_small", 1)]
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["width"], r["height"], r["nChannels"]) for r in out] == [(100, 90, 3)]


def test_resize_folder_keeps_broken_files_and_can_run_again(spark, tmp_path):
    noise = np.random.default_rng(1).integers(0, 256, (900, 1000, 3), dtype=np.uint8)
    write(tmp_path / "f" / "large.png", png_bytes(noise))
    write(tmp_path / "f" / "broken.png", bytes(noise)[:2_500_000])
    for folder in (f"file://{tmp_path}/f", str(tmp_path / "f") + "/"):
        gates = rows(image_jobs.resize_folder(spark, folder, str(tmp_path / "out"), box=100))
        assert gates == [("resize", 2)]
        out = {r["origin"].rsplit("/", 1)[1]: (r["width"], r["error"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
        assert out == {"large.png": (100, None), "broken.png": (-1, "unreadable")}
        assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_every_file_of_a_resize_has_an_outcome(spark, tmp_path):
    noise = np.random.default_rng(1).integers(0, 256, (900, 1000, 3), dtype=np.uint8)
    folder, out = str(tmp_path / "f"), str(tmp_path / "out")
    files = {"large.png": png_bytes(noise), "broken.png": bytes(noise)[:2_500_000], "small.png": png_bytes(noise[:9, :9]), "empty.png": b""}
    for name, content in files.items():
        write(tmp_path / "f" / name, content)
    image_jobs.resize_folder(spark, folder, out, box=100)
    write(tmp_path / "f" / "late.png", png_bytes(noise))
    found = image_jobs.resize_outcomes(spark, folder, out)
    assert {r["path"].rsplit("/", 1)[1]: r["outcome"] for r in found.collect()} == {
        "large.png": "resized", "broken.png": "unreadable", "small.png": "skip_small", "empty.png": "skip_empty", "late.png": "missing",
    }
    image_jobs.resize_folder(spark, folder, out, box=2000)
    counts = dict(rows(image_jobs.outcome_counts(image_jobs.resize_outcomes(spark, f"file://{folder}/", out))))
    # Not shrunk, but no JPEG either.
    assert counts == {"resized": 2, "unreadable": 1, "skip_small": 1, "skip_empty": 1}
    assert {r["origin"].rsplit("/", 1)[1]: r["changed"] for r in spark.read.parquet(out).collect()}["late.png"] is True


def test_annotations_without_a_partner_are_counted(spark, tmp_path):
    one = bundle_2022()
    one["annotations"] += [dict(one["annotations"][0], image_id="absent"), dict(one["annotations"][1], category_id=10**6, institution_id=10**6)]
    path = write(tmp_path / "meta.json", json.dumps(one))
    star = bundle.star_2022(bundle.read_bundles(spark, path, BUNDLE_2022))
    counts = dict(rows(training_set.write_year(star, str(tmp_path / "out"), 2022)))
    n = len(one["annotations"])
    assert counts == {
        "annotations": n, "written": n - 2, "dropped": 2, "without species": 0,
        "without images": 1, "without categories": 1, "without institutions": 1,
    }
    metadata = text_of(str(tmp_path / "out/train_2022_metadata.csv"), ".csv")
    assert metadata[0] == ",image_id,filename,species,genus,family,institution" and len(metadata) == n - 1
    written = [x for p in ("train", "val") for x in text_of(str(tmp_path / f"out/{p}_2022.json"), ".json")]
    assert len(written) == n - 2
    assert {json.loads(x)["name"]: json.loads(x)["n"] for x in text_of(str(tmp_path / "out/account_2022.json"), ".json")} == counts


def test_quality_of_folders(spark, tmp_path):
    pixels = np.full((4, 5, 3), 100, np.uint8)
    write(tmp_path / "a" / "x.png", png_bytes(pixels))
    write(tmp_path / "a" / "y.png", png_bytes(pixels))
    write(tmp_path / "b" / "recompressed_x.png", png_bytes(pixels + 3))
    write(tmp_path / "b" / "recompressed_y.png", png_bytes(pixels))
    write(tmp_path / "b" / "recompressed_z.png", b"broken")
    found = image_jobs.quality_of_folders(spark, str(tmp_path / "a"), f"file://{tmp_path}/b/", str(tmp_path / "log"))
    got = {r["stem"]: (r["mse"], r["identical"], r["error"]) for r in found.collect()}
    assert got == {"x": (9.0, False, None), "y": (0.0, True, None), "z": (None, None, "no original, unreadable copy")}


def test_damaged_and_lone_sides_keep_their_row(spark, tmp_path):
    pixels = np.full((4, 5, 3), 100, np.uint8)
    for name, content in {"a/p": png_bytes(pixels), "a/q": b"broken", "a/r": png_bytes(pixels), "a/s": png_bytes(pixels)}.items():
        write(tmp_path / f"{name}.png", content)
    for name, content in {"p": png_bytes(pixels)[:30], "q": png_bytes(pixels), "s": png_bytes(pixels[:2])}.items():
        write(tmp_path / "b" / f"recompressed_{name}.png", content)
    found = image_jobs.quality_of_folders(spark, str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "log"))
    got = {r["stem"]: (r["mse"], r["error"]) for r in found.collect()}
    assert got == {"p": (None, "unreadable copy"), "q": (None, "unreadable original"), "r": (None, "no copy"), "s": (None, "different sizes")}


def test_a_photograph_is_resampled_in_seconds():
    import time

    pixels = np.random.default_rng(0).integers(0, 256, (2000, 3000, 3), dtype=np.uint8)
    started = time.perf_counter()
    assert resample(pixels, 1024, 683).shape == (683, 1024, 3)
    assert time.perf_counter() - started < 10


def test_files_of_other_headers_stop_the_read(spark, tmp_path):
    write(tmp_path / "m" / "a.txt", "gbifID\tidentifier\tcountryCode\n1\tu\tUS\n")
    write(tmp_path / "m" / "b.txt", "countryCode\tgbifID\tidentifier\nUS\t2\tv\n")
    assert read_catalogue(spark, str(tmp_path / "m" / "b.txt")).first()["gbif_id"] == 2
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_catalogue(spark, str(tmp_path / "m")).collect()


def test_one_form_of_a_path(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert resolved("a/") == resolved(f"file://{tmp_path}/a") == resolved(str(tmp_path / "a")) == str(tmp_path / "a")
    assert resolved("s3://bucket/x/") == "s3://bucket/x"


def test_reorganise_folder(spark, tmp_path):
    for name in ("1234567.jpg", "sub/1234567.jpg", "note.txt", "IMG.png"):
        write(tmp_path / "flat" / name, b"x")
    moves, counts = image_jobs.reorganise(spark, str(tmp_path / "flat"), "store")
    assert rows(counts) == [("move", 2), ("skip", 1)]
    assert moves.filter("collision").count() == 2


def test_report_file(spark, tmp_path):
    catalogue = write(tmp_path / "m.txt", "gbifID\tidentifier\n1\ta\n1\tb\n2\tc\n")
    write(tmp_path / "st" / "processed_ids.txt", "1\n9\n")
    path = progress_report.write(spark, catalogue, str(tmp_path / "st"), str(tmp_path / "out"), datetime(2024, 5, 6, 7, 8))
    assert path.endswith("summary_202405060708.txt")
    lines = text_of(path, ".txt")
    assert lines[0] == "Run date: 2024-05-06 07:08:00"
    assert "Progress:                                50.00%" in lines
    assert "               2 | 1" in lines
    assert "⚠️  1 IDs in processed_ids.txt not found in multimedia.txt" in lines
    assert lines[-2].endswith("/out/summary_202405060708.txt")


def test_acquire_job(spark, tmp_path):
    catalogue = write(tmp_path / "m.txt", "gbifID\tidentifier\tcountryCode\n" + "".join(f"{i}\thttp://h/{i}.jpg\tUS\n" for i in range(1, 7)) + "2\thttp://h/iiif/2/manifest\tUS\n7\thttp://h/7.jpg\tDE\n")
    prior = write(tmp_path / "old.txt", "gbifID\n4\n")
    status = tmp_path / "st"
    write(status / "processed_ids.txt", "1\n")
    write(tmp_path / "store/5/000/5.jpg", b"x" * 20_000)
    write(tmp_path / "store/4/000/4.jpg", b"x")
    # The list is a folder from the first append on.
    lists = str(tmp_path / "lists")
    append_ids(spark.createDataFrame([("1",)], "id string"), f"{lists}/processed_ids.txt")
    inputs = acquire.read_inputs(spark, catalogue, lists, str(tmp_path / "store"), [prior], country="US")
    plan = acquire.plan(inputs)
    assert {r["id"]: r["action"] for r in plan.collect()} == {"1": "done", "2": "fetch", "3": "fetch", "4": "duplicate", "5": "record_done", "6": "fetch"}
    assert [r["id"] for r in acquire.removals(plan, inputs).collect()] == ["4"]
    body = json.dumps({"items": [{"type": "Canvas", "items": [{"type": "AnnotationPage", "items": [{"body": {"service": [{"id": "http://i/2"}]}}]}]}]})
    manifests = spark.createDataFrame([("http://h/iiif/2/manifest", body)], "url string, body string")
    links = acquire.links_to_try(plan, inputs, manifests).collect()
    assert sorted(r["pos"] for r in links if r["gbif_id"] == 2) == [1, 2, 3, 4]
    assert {r["gbif_id"] for r in links} == {2, 3, 6}
    acquire.record_present(plan, lists)
    now = datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [(20, 2, 0, "http://h/2", now, 404, None, None, None), (21, 2, 1, "http://i/2", now, 200, None, "image/png", None), (30, 3, 0, "http://h/3", now, 500, None, None, None), (60, 6, 0, "http://h/6", now, 200, None, None, None)],
        "attempt_id bigint, gbif_id bigint, seq int, url string, ts timestamp, status int, error_kind string, content_type string, retry_after string",
    )
    totals = acquire.settle(log, spark.createDataFrame([(60,)], "attempt_id bigint"), lists)
    assert rows(totals) == [("done", 1), ("failed", 2)]
    assert rows(read_id_set(spark, f"{lists}/processed_ids.txt")) == [("1",), ("2",), ("5",)]
    assert rows(read_id_set(spark, f"{lists}/failed_ids.txt")) == [("3",), ("6",)]
    gone = acquire.undecodable(log, spark.createDataFrame([(60,), (60,)], "attempt_id bigint"), "st/")
    assert [(r["gbif_id"], r["path"].rsplit("/", 1)[1]) for r in gone.collect()] == [(6, "6.jpg")]
    reached = acquire.milestones(log, plan, stored=7, intervals=(1, 9)).collect()
    assert sorted(tuple(r) for r in reached) == [(1, 8, 2, 2), (1, 9, 6, 1), (9, 9, 6, 1)]
    invalid, summary = link_check.check(log)
    assert {r["gbif_id"] for r in invalid.collect()} == {2, 6}
    assert summary.first().asDict() == {"checked": 4, "invalid": 2, "not_answered": 2}
    assert {r["gbif_id"] for r in link_check.check(log, any_image_type=True)[0].collect()} == {6}
    broken, top = acquire.host_summary(log)
    assert broken.first()["n_broken"] == 0 and rows(top) == [("h", 2)]


@pytest.mark.parametrize(
    ("body", "n"),
    [("not json", 0), ("{}", 0), ('{"items": 5}', 0), ('{"items":[{"type":"Range","items":[]}]}', 0), ('{"items":[{"type":"Canvas","items":[{"type":"AnnotationPage","items":[{"body":{"service":[{"id":"a"},{"x":1}]}},{}, {"body":{}}]}]}, {"type":"Canvas"}]}', 3), (None, 0)],
)
def test_manifests_of_every_kind(spark, body, n):
    from sheafwork.operators.candidates import manifest_urls

    df = spark.createDataFrame([("u", body)], "url string, body string")
    got = [(r["pos"], r["image_url"]) for r in manifest_urls(df).collect()]
    assert got == [(i, f"a/full/{w},/0/default.jpg") for i, w in enumerate((1600, 1200, 800))][:n]

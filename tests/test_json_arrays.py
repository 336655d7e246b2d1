"""JSON lists framed over byte ranges against the JSON reader, which takes each file whole."""

import json
import os
import random
import time

from graustein import schemas
from graustein.operators import elements as el
from graustein.sources import json_arrays, readers


def rows(df):
    return sorted(map(repr, df.collect()))


def text(pick):
    return "".join(pick.choice('ab{}[]",:\\ \n\té漢') for _ in range(pick.randint(0, 12)))


def element(pick, i):
    materials = {text(pick): {"volume": pick.random(), "density": 1.0} for _ in range(pick.randint(0, 4))}
    return {"id": f"e{i}", "guid": text(pick), "properties": {"ebkp": text(pick)}, "materials": list(materials), "material_volumes": materials}


class small_blocks:
    """Files are cut into ranges of a few hundred bytes."""

    def __init__(self, spark, size=300):
        self.conf, self.size = spark.conf, size

    def __enter__(self):
        self.conf.set("spark.sql.files.maxPartitionBytes", str(self.size))
        self.conf.set("spark.sql.files.openCostInBytes", "0")

    def __exit__(self, *_):
        self.conf.unset("spark.sql.files.maxPartitionBytes")
        self.conf.unset("spark.sql.files.openCostInBytes")


def write(folder, name, document, **how):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        json.dump(document, f, **how)


def test_framed_items_are_those_of_the_json_reader(spark, tmp_dir):
    pick = random.Random(4)
    many = [element(pick, i) for i in range(120)]
    write(tmp_dir, "list.json", many)
    write(tmp_dir, "spread.json", many, indent=2)
    write(tmp_dir, "object.json", {"elements": many, "metadata": {"total_elements": 3, "units": {"length": "m"}}}, ensure_ascii=False)
    write(tmp_dir, "behind.json", {"metadata": {"units": {"length": "}{", "area": "\"}"}}, "elements": many})
    write(tmp_dir, "one.json", [element(pick, 0)])
    write(tmp_dir, "none.json", [])
    write(tmp_dir, "empty.json", {"elements": [], "metadata": {"units": {"length": "m"}}})
    want = el.explode_documents(readers.read_element_documents(spark, tmp_dir)).select("source_file", "project_id", "e")
    whole = rows(want)
    with small_blocks(spark):
        framed = json_arrays.read_elements(spark, tmp_dir)
        assert rows(framed) == whole
        blocks = json_arrays._pieces(spark, os.path.join(tmp_dir, "object.json")).select("block").distinct().count()
        assert blocks > 20  # many tasks read one file
    assert rows(json_arrays.read_elements(spark, tmp_dir)) == whole
    assert len(whole) == 4 * 120 + 1


def test_order_and_other_lists(spark, tmp_dir):
    write(tmp_dir, "a.json", {"other": [{"id": "no"}, {"id": "no"}], "elements": [{"id": str(i)} for i in range(50)], "last": [{"id": "no"}, {"id": "no"}]})
    with small_blocks(spark, 64):
        got = json_arrays.read_items(spark, tmp_dir, schemas.ELEMENT).orderBy("n").collect()
    assert [r["e"]["id"] for r in got] == [str(i) for i in range(50)]


def test_mapping_lists_of_any_size(spark, tmp_dir):
    write(tmp_dir, "mappings.json", [{"ifc_material": f"m{i}", "kbob_id": "}" * (i % 3), "is_modelled": None if i % 2 else False} for i in range(60)])
    with small_blocks(spark, 100):
        got = readers.read_material_mappings(spark, tmp_dir, framed=True)
        assert rows(got) == rows(readers.read_material_mappings(spark, tmp_dir))


def test_life_expectancy_lists_of_any_size(spark, tmp_dir):
    path = os.path.join(tmp_dir, "life.json")
    with open(path, "w") as f:
        json.dump([{"ebkp_code": f"C{i}", "description": "x}", "years": i if i % 4 else None, "model_based": True} for i in range(40)], f)
    with small_blocks(spark, 100):
        assert rows(readers.read_life_expectancy(spark, path, framed=True)) == rows(readers.read_life_expectancy(spark, path))


def test_framed_elements_go_through_the_same_operators(spark, tmp_dir):
    pick = random.Random(9)
    write(tmp_dir, "house.json", {"elements": [element(pick, i) for i in range(30)]})
    whole = el.explode_documents(readers.read_element_documents(spark, tmp_dir))
    with small_blocks(spark):
        framed = json_arrays.read_elements(spark, tmp_dir)
        assert rows(el.flatten_elements(framed, as_of="2024-01-01")) == rows(el.flatten_elements(whole, as_of="2024-01-01"))
        assert rows(el.explode_materials(framed)) == rows(el.explode_materials(whole))
        assert rows(el.document_components(framed)) == rows(el.document_components(whole))


def test_large_documents_are_framed_and_others_read_whole(spark, tmp_dir):
    pick = random.Random(5)
    many = [element(pick, i) for i in range(60)]
    write(tmp_dir, "a house.json", {"elements": many, "metadata": {"total_elements": 60}})
    write(tmp_dir, "small.json", {"elements": many[:2]})
    write(tmp_dir, "bare.json", {**element(pick, 99), "object_type": "x" * 3000})  # large, without a list
    write(tmp_dir, "neither.json", {"metadata": {"total_elements": 1, "units": {"length": "m" * 3000}}})
    read = lambda **how: el.explode_documents(readers.read_element_documents(spark, tmp_dir, **how)).select("project_id", "e")
    assert rows(read(whole_bytes=2000)) == rows(read()) and len(rows(read())) == 63
    docs = readers.read_element_documents(spark, tmp_dir, whole_bytes=2000)
    assert docs.filter("size(elements) > 2").count() == 0  # no row holds the large document
    assert el.rejected_documents(docs).count() == 1


def test_framing_moves_no_texts_but_those_across_blocks(spark, tmp_dir, capsys):
    write(tmp_dir, "a.json", [{"id": str(i)} for i in range(300)])
    items = json_arrays.item_texts(spark, tmp_dir)
    items.explain("simple")
    plan = capsys.readouterr().out
    assert "Window" not in plan and "Sort [" not in plan.replace("SortMerge", "")
    assert items.count() == 300


def test_fixture_documents_are_bounded_and_whole(spark):
    from graustein.plans import registry
    sf = "/root/testdata/sf0.001"
    want = rows(registry.QUERIES["materials_from_json"](spark, sf))
    path = registry.json_documents(spark, sf, rows=50)
    docs = readers.read_element_documents(spark, path)
    sizes = [r[0] for r in docs.selectExpr("size(elements)").collect()]
    assert max(sizes) <= 51 and len(sizes) * 50 >= len(want)  # an empty element each besides
    got = el.explode_materials(el.explode_documents(docs)).select("element_id", "material_name", "volume", "density")
    assert rows(got) == want and rows(el.explode_materials(json_arrays.read_elements(spark, path)).select(*got.columns)) == want


def test_lines_and_braces_frame_the_same(spark, tmp_dir):
    pick = random.Random(11)
    many = [element(pick, i) for i in range(40)]
    lines = lambda end: ("," + end).join(json.dumps(x, ensure_ascii=False) for x in many)
    documents = {"lines": f"[{lines(chr(10))}]", "crlf": f"[{lines(chr(13) + chr(10))}]\r\n", "mark": f"\ufeff[\n{lines(chr(10))}\n]\n",
                 "object": '{"metadata":{"units":{"length":"{m}"}},"elements":[{}\n,' + lines("\n") + "\n]}\n",
                 "long": "[" + json.dumps({"id": "l", "object_type": "\\" * 700}) + ",\n" + lines("\n") + "]", "no lines": f"[{lines('')}]",
                 "blank": "\n \n[" + lines("\n \n") + "]"}
    for name, document in documents.items():
        with open(os.path.join(tmp_dir, f"{name}.json"), "w", encoding="utf-8", newline="") as f:
            f.write(document)
    found = {}
    for line_bytes in (64, 1000, 1 << 20):
        got = json_arrays.item_texts(spark, tmp_dir, line_bytes=line_bytes).collect()
        for r in sorted(got, key=lambda r: (r["file"], r["n"])):
            found.setdefault((line_bytes, os.path.basename(r["file"]).replace("%20", " ")), []).append(json.loads(r["text"]))
    for name in documents:
        want = [{}] * (name == "object") + [{"id": "l", "object_type": "\\" * 700}] * (name == "long") + many
        assert all(found[b, f"{name}.json"] == want for b in (64, 1000, 1 << 20)), name


def test_items_are_cut_line_by_line_and_never_shuffled_or_parsed_twice(spark, tmp_dir, capsys):
    with open(os.path.join(tmp_dir, "a.json"), "w") as f:
        f.write('{"elements":[{}\n' + "".join(f',{{"id":"{i}","properties":{{"ebkp":"C"}}}}\n' for i in range(300)) + "]}")
    seen = []
    pieces = json_arrays._pieces(spark, tmp_dir, sep="\n", longest=json_arrays.LINE_BYTES)
    assert pieces.count() == 302  # a row per line, not one per brace
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows_ = el.flatten_elements(json_arrays.read_elements(spark, tmp_dir)).select("id", "ebkp")
        rows_.explain("formatted")
        seen = capsys.readouterr().out.split("\n\n")
        assert sum(part.count("from_json(") for part in seen) == 1
        assert not any("raw#" in part for part in seen if "Exchange" in part.strip().split("\n")[0])
        assert sorted(int(r["id"]) for r in rows_.collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fields_that_nobody_asks_for_are_not_parsed(spark, tmp_dir):
    pick = random.Random(3)
    write(tmp_dir, "house.json", [element(pick, i) for i in range(20)])
    read = lambda **how: json_arrays.read_elements(spark, tmp_dir, **how)
    part = read(without=("materials", "material_volumes"))
    assert {"materials", "material_volumes"}.isdisjoint(part.schema["e"].dataType.names)
    assert rows(el.flatten_elements(part, as_of="2024-01-01")) == rows(el.flatten_elements(read(), as_of="2024-01-01"))


def test_shuffle_files_go_when_a_written_copy_is_done(spark):
    from graustein.session import SHUFFLE_CLEANUP, written_copy
    jvm, before = spark.sparkContext._jvm, spark.conf.get(SHUFFLE_CLEANUP, None)
    blocks = jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f.name() for f in (b for b in _scala(blocks.getAllBlocks())) if f.name().startswith("shuffle_")}
    earlier = held()
    copy = written_copy(spark.range(1000).groupBy("id").count(), "t")
    until = time.time() + 10  # they are removed behind the query's end
    while held() - earlier and time.time() < until:
        time.sleep(0.1)
    assert not held() - earlier
    assert copy.count() == 1000 and spark.conf.get(SHUFFLE_CLEANUP, None) == before


def _scala(seq):
    it = seq.iterator()
    while it.hasNext():
        yield it.next()

"""The README usage example, end to end from the reference's file formats."""

import json
import os

import pytest


def test_readme_usage_example(spark, tmp_dir):
    import graustein as gs
    from graustein.operators import elements as el
    from graustein.sources import readers
    root = tmp_dir
    with open(f"{root}/kbob.csv", "w", encoding="ISO-8859-1") as f:
        f.write('"UUID-Nummer","BAUMATERIALIEN","Treibhausgasemissionen, Total [kg CO2-eq]",'
                '"Primaerenergie nicht erneuerbar, Total [kWh oil-eq]","UBP (Total)","Rohdichte/ Flaechenmasse"\n'
                'E13EE05E,Hochbaubeton (ohne Bewehrung),232.3,402.5,351900,2300\n'
                '43B03F61,Glaswolle,340.615,1633.5,623150,30\n')
    with open(f"{root}/life.csv", "w") as f:
        f.write("eBKP-H Code,Description,Years,model-based?\nC,Rohbau,50,true\nD,Technik,30,true\n")
    with open(f"{root}/mappings.json", "w") as f:
        json.dump([{"ifc_material": "Beton", "kbob_id": "E13EE05E"},
                   {"ifc_material": "Wärmedämmung", "kbob_id": "43B03F61"}], f)
    os.makedirs(f"{root}/models")
    with open(f"{root}/models/haus.json", "w") as f:
        json.dump({"elements": [
            {"id": "test_beam_1", "properties": {"ebkp": "C"}, "materials": ["Beton"],
             "material_volumes": {"Beton": {"volume": 3.684, "density": 2300}}},
            {"id": "test_wall_1", "properties": {"ebkp": "D"}, "materials": ["Wärmedämmung"],
             "quantities": {"area": {"net": 12.5}},
             "material_volumes": {"Wärmedämmung": {"volume": 86.392, "density": 30}}}]}, f)
    with open(f"{root}/cost.csv", "w") as f:
        f.write("Code,Bezeichnung,reference,Kennwert\nD,Waende,m2,120.5\n")

    docs = readers.read_element_documents(spark, f"{root}/models")
    exploded = el.explode_documents(docs)
    version = "2024-6.2"
    inputs = gs.LcaInputs(
        elements=el.flatten_elements(exploded), materials=el.explode_materials(exploded),
        mappings=readers.read_material_mappings(spark, f"{root}/mappings.json"),
        catalogue=readers.read_kbob_csv(spark, f"{root}/kbob.csv", version),
        versions=spark.createDataFrame([(version, True)], "version string, is_active boolean"),
        life=readers.read_life_expectancy(spark, f"{root}/life.csv"))
    out = gs.run_combined(spark, inputs, readers.read_cost_csv(spark, f"{root}/cost.csv", version), f"{root}/out")
    got = {r["element_id"]: r for r in out["lca"].components.collect()}
    assert got["test_beam_1"]["gwp_absolute"] == pytest.approx(1968324.36)
    assert got["test_wall_1"]["gwp_relative"] == pytest.approx(29426.411)
    s = out["summary"].first()
    assert s["total_cost"] == pytest.approx(1506.25) and s["n_failed"] == 1

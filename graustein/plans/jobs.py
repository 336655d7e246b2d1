"""Composite jobs (C1, C2, C5, C6) as lazy DataFrame plans.

Every function returns DataFrames; nothing is collected except scalars (the active
version, a cost version). ``plans.runs`` persists these plans as tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from graustein.operators import catalogue as cat
from graustein.operators import cost as cost_ops
from graustein.operators import elements as el
from graustein.operators import lca as lca_ops


@dataclass
class LcaInputs:
    elements: DataFrame        # ifc_elements layout (id, project_id, ebkp, ...)
    materials: DataFrame       # ifc_element_materials layout
    mappings: DataFrame        # ifc_material, kbob_id [, project_id, created_at]
    catalogue: DataFrame       # kbob_materials
    versions: DataFrame        # kbob_versions
    life: DataFrame            # life_expectancy


def lca_input_rows(elements: DataFrame, materials: DataFrame, validate: bool = True) -> DataFrame:
    """J6 + P11: element x material rows of valid elements."""
    return el.valid_component_rows(materials, elements) if validate else el.attach_elements(materials, elements)


def lca(inputs: LcaInputs, validate: bool = True, normalise_life: bool = False,
        version: str | None = None) -> tuple[DataFrame, str]:
    """Component rows (good and failed) and the catalogue version used."""
    version = version or cat.active_version(inputs.versions)
    rows = lca_input_rows(inputs.elements, inputs.materials, validate)
    comps = lca_ops.lca_components(rows, inputs.mappings, inputs.catalogue, inputs.life, version,
                                   normalise_life=normalise_life)
    return comps, version


def cost(elements: DataFrame, cost_reference: DataFrame, version: str | None = None) -> DataFrame:
    """One cost row per element (good or failed)."""
    return cost_ops.cost_components(elements, cost_reference, version)


def remap_and_recompute(inputs: LcaInputs, project_id: str, new_mapping: DataFrame,
                        all_mappings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replace one project's mappings (M9), then recompute only that project."""
    from pyspark.sql import functions as F
    from graustein.operators.maintenance import replace_project_mappings
    version = cat.active_version(inputs.versions)
    mappings = replace_project_mappings(all_mappings, project_id, new_mapping, version)
    scoped = LcaInputs(inputs.elements.filter(F.col("project_id") == F.lit(project_id)), inputs.materials,
                       mappings.filter((F.col("project_id") == F.lit(project_id)) | F.col("project_id").isNull()), inputs.catalogue,
                       inputs.versions, inputs.life)
    comps, _ = lca(scoped, version=version)
    return mappings, comps


@dataclass
class Difference:
    mappings: DataFrame    # all mappings after the change (M9)
    materials: DataFrame   # material_name of the materials that resolve to something else now
    gone: DataFrame        # the stored components that no longer hold
    components: DataFrame  # what takes their place
    totals: DataFrame      # the project's totals after the change


def remap_difference(inputs: LcaInputs, project_id: str, new_mapping: DataFrame, all_mappings: DataFrame,
                     stored: DataFrame, totals: DataFrame, version: str | None = None) -> Difference:
    """C5 by difference: as ``remap_and_recompute``, but only the components of materials whose catalogue
    id changed are computed again, and the totals follow by subtracting the old rows and adding the new.

    ``stored`` are the project's components and ``totals`` its ``project_impacts`` from before. Which elements
    are valid doesn't depend on mappings: the stored rows tell. The element table isn't read at all, and of the
    materials only the rows whose name changed."""
    from pyspark.sql import functions as F
    from graustein.operators.maintenance import replace_project_mappings
    version = version or cat.active_version(inputs.versions)
    mappings = replace_project_mappings(all_mappings, project_id, new_mapping, version)
    before = lca_ops.resolved_mapping(all_mappings, project_id).withColumnRenamed("kbob_id", "before")
    after = lca_ops.resolved_mapping(mappings, project_id).withColumnRenamed("kbob_id", "after")
    changed = before.join(after, "material_name", "full").filter(~F.col("before").eqNullSafe(F.col("after"))).select("material_name")
    gone = stored.filter(F.col("project_id") == F.lit(project_id)).join(changed, "material_name", "left_semi").select(*stored.columns)
    keys = gone.select("project_id", "element_id", "material_name", F.col("ebkp_h").alias("ebkp"))
    rows = inputs.materials.select("element_id", "material_name", "volume", "density").join(changed, "material_name", "left_semi").join(
        keys.distinct(), ["element_id", "material_name"])
    scoped = mappings.filter((F.col("project_id") == F.lit(project_id)) | F.col("project_id").isNull())
    new = lca_ops.lca_components(rows, scoped, inputs.catalogue, inputs.life, version)
    return Difference(mappings, changed, gone, new, lca_ops.impact_difference(totals, gone, new))

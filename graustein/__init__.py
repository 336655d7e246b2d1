"""graustein: building life-cycle impact and cost analytics on Spark DataFrames.

Element material layers are joined to their reference data (material mapping,
versioned material catalogue, service life, cost key figures), impacts and costs are
computed with built-in column expressions, rows that cannot be computed are routed
to an error table with a reason code, and per-element, per-project and run-level
results are produced.

The main entry points are importable from the package (loaded on first use)::

    import graustein as gs
    comps, version = gs.lca(gs.LcaInputs(elements, materials, mappings, catalogue, versions, life))
    costs = gs.cost(elements, cost_reference)
    gs.run_combined(spark, inputs, cost_reference, out_root)   # persisted LCA + cost + report
"""

__version__ = "0.1.0"

_EXPORTS = {
    "LcaInputs": "graustein.plans.jobs", "lca": "graustein.plans.jobs", "cost": "graustein.plans.jobs",
    "remap_and_recompute": "graustein.plans.jobs",
    "run_lca": "graustein.plans.runs", "run_cost": "graustein.plans.runs", "run_combined": "graustein.plans.runs",
    "load_reference_data": "graustein.plans.runs",
    "ingest": "graustein.plans.ingest", "documents_to_tables": "graustein.plans.ingest",
    "project_info": "graustein.operators.projects", "material_volumes": "graustein.operators.projects",
    "project_mappings_in_use": "graustein.operators.projects",
    "combine_results": "graustein.operators.combine", "summarize": "graustein.operators.combine",
    "report_lines": "graustein.operators.combine",
    "normalize_code": "graustein.functions.ebkp",
    "local_session": "graustein.session", "checkpoint_dir": "graustein.session",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'graustein' has no attribute {name!r}")

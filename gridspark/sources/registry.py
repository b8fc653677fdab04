"""Names of the published tables.

Fixed values: each group lists its tables by main name, with further names in brackets. A table is
stored under ``<group>/<main name>`` unless the catalog is told otherwise.
"""

from __future__ import annotations

GROUPS: dict[str, dict[str, tuple[str, ...]]] = {
    "ltds": {
        "table_1": ("circuit_data",),
        "table_2a": ("transformer_2w",),
        "table_2b": ("transformer_3w",),
        "table_3a": ("observed_demand", "observed_peak_demand"),
        "table_3a_transposed": (),
        "table_3b": ("forecast_demand",),
        "table_4a": ("fault_level_3ph",),
        "table_4b": ("fault_level_earth",),
        "table_5": ("generation",),
        "table_6": ("connection_interest",),
        "table_7": ("restrictions",),
        "table_8": ("fault_data",),
        "projects": ("infrastructure_projects",),
        "cim": (),
    },
    "dfes": {"headroom": ("headroom_report",), "peak_demand_scenarios": (), "by_local_authority": ()},
    "dnoa": {"dnoa": (), "lv_dnoa": ()},
    "network_stats": {"statistics": ("network_statistics",), "losses": (), "power_quality": (), "iis": ()},
    "powerflow": {
        "132kv_monthly": (),
        "132kv_half_hourly": (),
        "33kv_monthly": (),
        "33kv_half_hourly_epn": (),
        "33kv_half_hourly_spn": (),
        "grid_monthly": (),
        "grid_half_hourly": (),
        "primary_monthly": (),
        "primary_half_hourly_epn": (),
        "primary_half_hourly_spn": (),
    },
    "flexibility": {"dispatches": ("dispatch_events",), "tenders": ()},
    "curtailment": {"events": ("site_specific", "curtailment", "curtailment_events")},
    "ders": {
        "ecr": ("embedded_capacity",),
        "ecr_small": ("embedded_capacity_small",),
        "large_demand": (),
        "large_power_stations": (),
    },
    "gis": {
        "primary_areas": (),
        "secondary_areas": (),
        "grid_areas": (),
        "secondary_sites": (),
        "grid_primary_sites": (),
        "grid_supply_points": (),
        "hv_overhead_lines": (),
        "lv_overhead_lines": (),
        "33kv_overhead_lines": (),
        "132kv_overhead_lines": (),
        "hv_poles": (),
        "lv_poles": (),
        "33kv_poles": (),
        "132kv_poles": (),
        "licence_boundaries": (),
        "epn_boundaries": (),
        "spn_boundaries": (),
        "lpn_boundaries": (),
        "idno_areas": (),
    },
    "equipment": {
        "grid_transformers": (),
        "primary_transformers": (),
        "secondary_transformers": (),
        "super_grid_transformers": (),
        "secondary_utilisation": (),
    },
    "connections": {
        "queue_insights": (),
        "gsp_insights": (),
        "gsp_narrative": (),
        "gsp_project_status": (),
        "wide_planning": (),
        "modifications": (),
        "connections_reform": (),
    },
    "operations": {
        "constraint_readings": (),
        "constraint_history": (),
        "ehv_outages": (),
        "live_faults": (),
        "rota_disconnect": (),
    },
    "sensitivity": {"sensitivity_import": (), "sensitivity_export": ()},
    "smart_lct": {
        "smart_meter_substation": (),
        "smart_meter_feeder": (),
        "smart_meter_volumes": (),
        "lct_lsoa": (),
        "lct_secondary": (),
        "low_carbon_tech": (),
    },
    "profiles": {"demand_profiles": (), "generation_profiles": (), "data_centre_profiles": ()},
    "appendix_g": {
        "appendix_g": (),
        "appendix_g_aggregated": (),
        "appendix_g_progression": (),
        "appendix_g_conditions": (),
        "appendix_g_summary": (),
    },
    "reference": {
        "local_authorities": (),
        "glossary": (),
        "data_roadmap": (),
        "data_maturity": (),
        "chargepoints": (),
    },
}

# Groups that only collect names of other groups.
GROUP_VIEWS: dict[str, tuple[str, ...]] = {
    "network": (
        "132kv_monthly",
        "132kv_half_hourly",
        "33kv_monthly",
        "statistics",
        "network_statistics",
        "demand_profiles",
    ),
}

# Tables with a geometry, which a bounds query reads by default.
GEO_TABLES: tuple[str, ...] = (
    "primary_areas",
    "secondary_areas",
    "grid_areas",
    "secondary_sites",
    "grid_primary_sites",
    "grid_supply_points",
    "hv_overhead_lines",
    "lv_overhead_lines",
    "33kv_overhead_lines",
    "132kv_overhead_lines",
    "hv_poles",
    "lv_poles",
    "33kv_poles",
    "132kv_poles",
    "licence_boundaries",
    "projects",
    "infrastructure_projects",
    "by_local_authority",
)

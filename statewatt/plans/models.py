"""The model tables by name, each built on demand from the inputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewatt.plans import commercial, config, fuel, grid, infrastructure, integration, residential, transition
from statewatt.session import stored


def _stored(name: str, df: DataFrame) -> DataFrame:
    return stored(df)


class Models:
    """Model tables over a mapping of input name -> DataFrame.

    Tables are plans until used. The few small tables that several later ones
    read go through ``keep(name, df)``, by default a parquet copy in the shared
    checkpoint folder; pass a function to name and place them yourself.
    ``fanout='dedup'`` removes the join fan-out of the published formulas.
    """

    def __init__(
        self,
        inputs: Mapping[str, DataFrame],
        keep: Callable[[str, DataFrame], DataFrame] = _stored,
        fanout: str = "keep",
    ) -> None:
        self.inputs = inputs
        self.keep = keep
        self.fanout = fanout

    def __getitem__(self, table: str) -> DataFrame:
        if table not in TABLES:
            raise KeyError(table)
        return getattr(self, table)

    def report(self, table: str) -> DataFrame:
        """A table in its reading order; stored tables carry no order."""
        order = [F.col(c).desc() if down else F.col(c).asc() for c, down in REPORT_ORDER.get(table, {}).items()]
        return self[table].orderBy(*order) if order else self[table]

    # inputs ----------------------------------------------------------------

    def _input(self, name: str) -> DataFrame:
        return self.inputs[name]

    @cached_property
    def _generators(self) -> DataFrame:
        return self._input("out_eia__monthly_generators")

    @cached_property
    def _hourly(self) -> DataFrame:
        return self._input("out_eia930__hourly_operations")

    @cached_property
    def _sales(self) -> DataFrame:
        return self._input("raw_eia861__yearly_sales")

    @cached_property
    def market_structure_ref(self) -> DataFrame:
        return residential.structure_with_access(self._input("market_structure_ref"))

    @cached_property
    def _overrides(self) -> DataFrame:
        if "growth_overrides" in self.inputs:
            return self._input("growth_overrides")
        rows = config.GROWTH_OVERRIDES
        return self._sales.sparkSession.createDataFrame(rows, "state string, dc_growth_flag string")

    # grid stress -------------------------------------------------------------

    @cached_property
    def module_a_base(self) -> DataFrame:
        generation = self._input("out_eia923__monthly_generation_fuel_combined")
        return self.keep("module_a_base", grid.generation_base(generation, self._generators, self.fanout))

    @cached_property
    def module_a_monthly_metrics(self) -> DataFrame:
        return self.keep("module_a_monthly_metrics", grid.monthly_metrics(self.module_a_base, self._generators))

    @cached_property
    def ba_state_mapping(self) -> DataFrame:
        return grid.area_states(self._generators)

    @cached_property
    def module_a_ramp_rates(self) -> DataFrame:
        return grid.generation_ramps(self._hourly)

    @cached_property
    def module_a_additional_ramps(self) -> DataFrame:
        return grid.additional_ramps(self._hourly)

    @cached_property
    def module_a_hourly_final(self) -> DataFrame:
        return grid.hourly_metrics(self._hourly)

    @cached_property
    def module_a2_state_hourly_metrics(self) -> DataFrame:
        return grid.state_hourly_metrics(self.module_a_hourly_final, self.ba_state_mapping)

    # fuel cost ---------------------------------------------------------------

    @cached_property
    def module_b_base(self) -> DataFrame:
        return fuel.price_base(self._input("out_eia923__monthly_fuel_receipts_costs"))

    @cached_property
    def module_b_cost_per_mwh(self) -> DataFrame:
        return fuel.cost_per_mwh(self.module_b_base)

    @cached_property
    def module_b_metrics(self) -> DataFrame:
        return self.keep("module_b_metrics", fuel.cost_metrics(self.module_b_cost_per_mwh))

    @cached_property
    def module_b_cost_spread(self) -> DataFrame:
        return fuel.cost_spread(self.module_b_metrics)

    # concentration and transition ----------------------------------------------

    @cached_property
    def module_c_concentration(self) -> DataFrame:
        return transition.fuel_concentration(self.module_a_monthly_metrics)

    @cached_property
    def module_c_renewable_trend(self) -> DataFrame:
        return transition.renewable_trend(self.module_a_base)

    @cached_property
    def module_c_summary(self) -> DataFrame:
        return transition.transition_summary(self.module_c_concentration, self.module_c_renewable_trend)

    @cached_property
    def module_c_fuel_share(self) -> DataFrame:
        return transition.fuel_share(self.module_a_monthly_metrics)

    # infrastructure and policy -------------------------------------------------

    @cached_property
    def module_d_industrial_load(self) -> DataFrame:
        return infrastructure.industrial_load(self._sales)

    @cached_property
    def module_d_storage_deployment(self) -> DataFrame:
        return infrastructure.storage_deployment(self._input("raw_eia860__storage_generators"), self._generators)

    @cached_property
    def module_d_reliability(self) -> DataFrame:
        return infrastructure.reliability(self._input("raw_eia861__yearly_reliability"))

    @cached_property
    def module_d_regulatory_receptiveness(self) -> DataFrame:
        return infrastructure.regulatory_receptiveness(
            self._input("raw_eia861__yearly_energy_efficiency"), self._input("raw_eia861__yearly_demand_response"), self.fanout
        )

    @cached_property
    def module_ref_cooperative_density(self) -> DataFrame:
        return infrastructure.cooperative_density(self._sales, self.module_d_reliability)

    # scores ------------------------------------------------------------------

    @cached_property
    def integration_base(self) -> DataFrame:
        base = integration.base_table(
            self.module_a2_state_hourly_metrics,
            self.module_a_monthly_metrics,
            self.module_b_metrics,
            self.module_b_cost_spread,
            self.module_c_summary,
        )
        return self.keep("integration_base", base)

    @cached_property
    def integration_scores(self) -> DataFrame:
        scores = integration.score_table(
            self.integration_base,
            self._input("market_structure_ref"),
            self.module_d_industrial_load,
            self.module_d_storage_deployment,
            self.module_d_reliability,
            self.module_d_regulatory_receptiveness,
            self._input("raw_dsire_incentive_scores"),
        )
        return self.keep("integration_scores", scores)

    @cached_property
    def module_e_residential_market(self) -> DataFrame:
        return residential.residential_market(self._sales)

    @cached_property
    def module_e_residential_score(self) -> DataFrame:
        return residential.residential_score(self.module_e_residential_market, self.integration_scores, self.market_structure_ref)

    @cached_property
    def module_f_dc_score(self) -> DataFrame:
        return commercial.data_center_score(self._input("raw_dc_metrics"), self.market_structure_ref, self._overrides)

    @cached_property
    def module_f_ci_market(self) -> DataFrame:
        return commercial.business_market(self._sales, self.integration_scores)

    @cached_property
    def module_f_ci_score(self) -> DataFrame:
        return commercial.business_score(
            self.module_f_ci_market, self.integration_scores, self.market_structure_ref, self.module_f_dc_score
        )

    @cached_property
    def integration_final_grid(self) -> DataFrame:
        return integration.final_grid(self.integration_scores)

    @cached_property
    def integration_final_residential(self) -> DataFrame:
        return integration.final_residential(self.module_e_residential_score, self.integration_scores)

    @cached_property
    def integration_final_ci(self) -> DataFrame:
        return integration.final_business(self.module_f_ci_score, self.module_f_dc_score)


#: Reading order: column -> whether it descends.
REPORT_ORDER: dict[str, dict[str, bool]] = {
    "module_a_monthly_metrics": {"state": False, "fuel_type_code_pudl": False},
    "ba_state_mapping": {"balancing_authority_code_eia": False},
    "module_a_hourly_final": {"null_count": False},
    "module_a2_state_hourly_metrics": {"state": False},
    "module_b_base": {"state": False, "fuel_type_code_pudl": False, "period": False},
    "module_b_cost_per_mwh": {"state": False, "fuel_type_code_pudl": False, "period": False},
    "module_b_metrics": {"state": False, "fuel_type_code_pudl": False},
    "module_b_cost_spread": {"oil_coal_spread": True},
    "module_c_concentration": {"hhi_concentration": True},
    "module_c_renewable_trend": {"variable_re_growth": True},
    "module_c_summary": {"variable_re_growth_pct": True},
    "module_c_fuel_share": {"state": False, "fuel_type_code_pudl": False},
    "module_d_industrial_load": {"industrial_pct": True},
    "module_d_storage_deployment": {"storage_units": True},
    "module_d_reliability": {"saidi_weighted_avg": True},
    "module_d_regulatory_receptiveness": {"ee_savings_mwh": True},
    "module_ref_cooperative_density": {"cooperative_customer_pct": True},
    "module_e_residential_market": {"residential_customers": True},
    "module_e_residential_score": {"residential_composite_score": True},
    "module_f_dc_score": {"dc_composite_score": True, "dc_twh_per_year": True},
    "module_f_ci_market": {"state": False},
    "module_f_ci_score": {"ci_composite_score": True},
    "integration_base": {"state": False},
    "integration_final_grid": {"opportunity_rank": False},
    "integration_final_residential": {"opportunity_rank": False},
    "integration_final_ci": {"opportunity_rank": False},
}

TABLES = [name for name, member in vars(Models).items() if isinstance(member, cached_property) and not name.startswith("_")]

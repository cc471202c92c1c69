from statewatt.plans.models import REPORT_ORDER, TABLES, Models
from statewatt.plans.territory import facilities_in_territory, territory_report

__all__ = ["REPORT_ORDER", "TABLES", "Models", "facilities_in_territory", "territory_report"]

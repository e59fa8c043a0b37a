from tillscope.plans.retail_job import (
    RetailReport,
    plan_catalogue,
    run_retail_job,
    save_catalogues,
)

__all__ = ["RetailReport", "plan_catalogue", "run_retail_job", "save_catalogues"]

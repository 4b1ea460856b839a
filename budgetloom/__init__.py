"""Budget facts and accrual validation as PySpark DataFrame jobs."""

"""millrace: analytics tables from messy CSV, JSON and log data, built on the PySpark DataFrame API.

Every public function takes and returns ``Column`` or ``DataFrame`` objects, so it composes with
``DataFrame.transform`` and Catalyst sees the whole job as one plan.
"""

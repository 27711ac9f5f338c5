"""furlong: race-result CSV stacking and trailing-form features on Spark.

User entry points (``furlong.plans.jobs``):

* ``stack_crawl``         -- crawled CSV folders stacked by column name, deduplicated, with ids
* ``feature_table``       -- 26 typed base columns + 165 trailing averages (skew-safe by default)
* ``write_feature_table`` -- create-or-replace as Parquet or a managed table

* ``load_table``          -- a stacked CSV folder as a typed table
* ``crawl_to_features``   -- all of it, from crawled folders to the feature table

Building blocks: ``functions.exprs`` (Column expressions), ``operators.base`` /
``operators.trailing`` / ``operators.skew`` / ``operators.checks``,
``sources.csv_stack``.  ``llm`` is an optional subpackage of training-data
operators that nothing else imports.
"""

__version__ = "0.1.0"

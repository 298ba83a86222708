"""Whole jobs (compositions of operators) and their bindings to the driver's tables.

* ``permits``           the five named permit queries, ``run_named_query``, ``permit_extract_job``
* ``weekly``            the weekly measure table: from extract files, from the permit table in one
                        plan, or from a one-pass tagging of a single table
* ``active_log``        rotated snapshot of active permits, upserted on its publish minute
* ``sheets``            sheet exports counted per calendar date
* ``service_requests``  UTF-16 report -> projected, cleaned rows -> upsert
* ``flex_notes``        question/answer rows minus a deny-list -> upsert
* ``finance``           report slices per (department, fiscal year, month end); report files ->
                        derived calendar fields and row identifiers -> upsert
* ``catalog``           nested catalog assets -> flat table with row counts -> replace
* ``bindings``/``oracle`` the registered queries over the driver tables and their DuckDB SQL
"""

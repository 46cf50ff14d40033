"""branchbook — branch P&L allocation and sales-performance reporting on Spark.

Sub-packages:

* ``sources``   — schemas, fixed seed dimensions, readers/writers, and the
  bindings that derive the domain tables from the TPC-H-like test tables;
* ``functions`` — column expressions (code decoding, month arithmetic,
  null-ordering helpers);
* ``operators`` — DataFrame operators: reshape, allocation ratios, fused line
  allocation, rollup, ranking, report views, data checks;
* ``plans``     — composite reports (finance, ASM), the monthly runner and the
  registered queries with their SQL oracles;
* ``streaming`` — file-arrival trigger for the monthly runner.
"""

__version__ = "0.1.0"

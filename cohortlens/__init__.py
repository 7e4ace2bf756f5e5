"""cohortlens — panel-survey analytics as Spark DataFrame jobs.

Layers:
  sources/    readers and writers: yearly wide CSVs, the driver-table panel, table store
  functions/  column-expression building blocks (rule tables, text guards)
  operators/  DataFrame -> DataFrame operators (explode, cleaning, shares, ranks,
              exact distributed order statistics)
  plans/      the audit and trend jobs built from the operators, plus their SQL oracles
"""

__version__ = "0.1.0"

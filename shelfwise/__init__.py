"""shelfwise: product-catalogue search and recommendation on Spark DataFrames.

Every operator is a pure ``DataFrame -> DataFrame`` function (usable with
``df.transform``); nothing in a library path collects rows to the driver.
"""

__version__ = "0.1.0"

"""tessera: a Spark-native engine for code and text corpora.

Every operator is a function ``DataFrame -> DataFrame`` (or a ``Column``
builder); nothing is collected to the driver.
"""

__version__ = "0.1.0"

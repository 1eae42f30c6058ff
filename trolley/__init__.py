"""trolley: shopping-basket feature marts, classifiers and evaluation on Spark DataFrames."""

__version__ = "0.1.0"

"""Text analytics and classification on Spark DataFrames.

Every operator is a function from DataFrames to DataFrames. Fitted state (a
vocabulary, a language model, class weights) is itself a DataFrame or a small
dataclass of DataFrames, so it can be stored, queried and joined like any table.
"""

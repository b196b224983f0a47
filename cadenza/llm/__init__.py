"""Training-data operators over large document tables (see README, "Training-data operators").

Every operator takes DataFrames, reads whole tables and whole texts, and returns a DataFrame.
``cadenza.llm.queries`` registers one query per operator.
"""

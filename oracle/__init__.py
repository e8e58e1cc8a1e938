"""The same feeds and results in DuckDB SQL, used only to check the Spark plans."""

"""Plans: load policy, the daily ETL, export, and the registered reports."""

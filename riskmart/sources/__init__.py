"""Reading and writing of the tables: raw files, partitioned tables, contracts and model cards."""

"""Sources: dated CSV landings, overwritten snapshots, JDBC tables, binary files and JSON documents."""

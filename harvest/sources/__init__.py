"""Sources: landed JSON pages, snapshots, HTML pages, file inventories."""

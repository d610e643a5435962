"""Change-event analytics on PySpark: landed JSON pages -> raw -> staging -> daily mart -> reports and checks."""

"""spanwatch: road-speed enforcement between camera gantries, as Spark jobs.

Camera passages come in as a bounded table or an event-time stream; the same
DataFrame functions decode, enrich and judge them in both cases. See README.md
for the layout and for the scale decisions behind each operator.
"""

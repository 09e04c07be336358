"""skygrid: earth-observation tables on Spark DataFrames."""
